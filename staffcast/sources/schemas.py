"""Declared schemas of the inputs. Column names are fixed values of the data contract."""

REQUESTS = """
request_code string, status string, sub_status string, request_creation_date date, closure_date date,
need_date date, change_date date, closure_request_date date, positions_filled int,
required_positions int, desired_salary double, sales_agent string, region string, job_role string,
service_type string, request_type string, hr_manager string, minimum_requirements string,
work_area string, remote_work string, rate_type string, priority string, tech_hours double,
community_tech_hours double, applicant_tech_hours_12 double, applicant_tenure double,
tech_tenure double, average_salary double, average_salary_12 double,
consolidation_probability double, coverage_probability double, languages string,
request_difficulty int, job_level int, client_code string, final_client string
"""

SALARY = """
salary double, insertion_date date, remote_percentage int, profile string, tenure int, region string,
job_level int
"""

DATE_COLUMNS = ("request_creation_date", "change_date", "closure_request_date", "closure_date", "need_date")
