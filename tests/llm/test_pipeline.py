"""The corpus pipeline against plain versions of its stages, and the entry without this subpackage."""

import subprocess
import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from staffcast.llm.feistel import key_of, pseudonymized
from staffcast.llm.rule_ensemble import score_quality
from tests.llm.helpers import contamination, fingerprint, frame, groups
from tests.llm.test_packing import placed

DATA = "/root/testdata/sf0.001"


def test_every_stage_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "PII", "best-fit packing"]
    rows = {r.doc_id: r for r in docs.collect()}

    kept = steps["quality classifier"](spark, docs, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scored, _ = score_quality(docs, "doc_id", "text", labels, "doc_id", "quality")
    good = {r.kept.id for r in scored.collect() if r.predicted}
    assert kept.columns == docs.columns and {r.doc_id: r for r in kept.collect()} == {i: rows[i] for i in good}
    low = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(low - good) >= 0.7 * len(low)

    single = steps["SimHash near-dedup"](spark, kept, DATA)
    prints = {i: fingerprint(rows[i].text) for i in good}
    group = groups(sorted(good), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    firsts = set(group.values())
    assert single.columns == docs.columns and {r.doc_id: r for r in single.collect()} == {i: rows[i] for i in firsts}

    clean = steps["benchmark decontamination"](spark, single, DATA)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    order = sorted(firsts)
    left = {i for i, (_, hit, _) in zip(order, contamination([rows[i].text for i in order], items), strict=True) if not hit}
    assert clean.columns == docs.columns and {r.doc_id: r for r in clean.collect()} == {i: rows[i] for i in left}

    private = steps["PII"](spark, clean, DATA)
    want = {r.doc_id: r.text for r in pseudonymized(clean, "text", key_of(spark)).collect()}
    got = {r.doc_id: r for r in private.collect()}
    assert private.columns == docs.columns and {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values()) and any(want[i] != rows[i].text for i in want)

    packed = corpus_pipeline.run(spark, DATA).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {}
    for r in sorted(packed, key=lambda r: (r.doc_id, r.piece)):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    assert ids == {i: [*whole.encode(t, add_special_tokens=False).ids, 0] for i, t in want.items()}
    sequences = placed(packed, 2048)
    assert len(sequences) <= 1.02 * -(-sum(map(len, ids.values())) // 2048) + 1


def test_odd_documents_pass_all_stages(spark):
    texts = [None, "", " ", "a", "a", "mail me at a.b@c.example.com " * 3, "x" * 20_000, "good plain words for once"]
    docs = frame(spark, texts).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.union(docs.where("doc_id = 3")).union(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, DATA)
        assert out.columns == docs.columns
        out.collect()
        assert step(spark, docs.limit(0), DATA).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() >= docs.count()


def test_queries_are_registered():
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    for k in range(1, 11):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1


def test_entry_without_this_subpackage(tmp_path):
    """The rest imports and keeps its queries when the subpackage and the pipeline are gone."""
    root = Path(entry.__file__).parent
    for name in ("__spark_entry__.py", "checks", "staffcast"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        if name == "staffcast":
            (tmp_path / name).mkdir()
            for p in (root / name).iterdir():
                if p.name != "llm":
                    (tmp_path / name / p.name).symlink_to(p)
        else:
            (tmp_path / name).symlink_to(root / name) if name == "checks" else (tmp_path / name).write_bytes((root / name).read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'lof' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
