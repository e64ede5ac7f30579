"""The registered queries on the small tables: against SQL, and the pipeline
against plain models of its stages."""

import os
import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD, docs, sentences, shingles
from pyspark.sql import functions as F
from test_dedup import groups
from test_scans import contamination

import corpus_pipeline
from tunnelscan.llm import pii, queries
from tunnelscan.session import shared_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    out, want = queries.QUERIES[name](spark, SF), duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(out.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(repr, out.select(*columns).toArrow().to_pylist())) == sorted(
        repr(dict(zip(columns, row))) for row in duck.sql(
            f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name].strip()})").fetchall())


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def _rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_pipeline_stages_equal_plain_models(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    columns, step = source.columns, dict(corpus_pipeline.STAGES)
    clean = step["toxicity"](spark, source, SF)
    scored = {r["doc_id"]: r["toxic"] for r in queries.toxicity(spark, SF).collect()}
    kept = _rows(clean)
    assert set(kept) == {i for i, toxic in scored.items() if not toxic}

    single = step["near_duplicates"](spark, clean, SF)
    want = groups([(i, r["text"]) for i, r in kept.items()], corpus_pipeline.SIMILAR)
    kept = {i: r for i, r in kept.items() if want[i] == i}
    assert set(_rows(single)) == set(kept)

    apart = step["decontaminate"](spark, single, SF)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = contamination([(i, r["text"]) for i, r in kept.items()], items)
    kept = {i: r for i, r in kept.items() if not found[i][4]}
    assert set(_rows(apart)) == set(kept)

    private = step["pseudonymise"](spark, apart, SF)
    p = pii.Permutation(pii.DEMO_KEY)
    texts = {i: pii.pseudonyms(r["text"], p)[0] for i, r in kept.items()}
    assert {i: r["text"] for i, r in _rows(private).items()} == texts
    assert any(texts[i] != r["text"] for i, r in kept.items())

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = _rows(step["tokenize"](spark, private, SF))
    assert {i: r["ids"] for i, r in out.items()} == {i: library.encode(t) for i, t in texts.items()}
    assert all(r["round_trip"] and r["decoded"] == texts[i] for i, r in out.items())
    for frame in (clean, single, apart, private):
        assert frame.columns == columns
    assert {i: r["ids"] for i, r in _rows(corpus_pipeline.run(spark, SF)).items()} == {i: r["ids"] for i, r in out.items()}


def test_near_duplicate_stage_takes_pairs_from_080(spark):
    rng, rows = random.Random(3), []
    for k in range(30):
        w = [f"{k}x{rng.randrange(10 ** 6)}" for _ in range(204)]
        # 200 shingles; a changed word within takes five from each side.
        for at in range(10, 10 + 20 * (3 + k % 3), 20):
            rows.append((2 * k, " ".join(w))) if at == 10 else None
            w[at] = f"changed{k}at{at}"
        rows.append((2 * k + 1, " ".join(w)))
    sets = {i: shingles(t) for i, t in rows}
    alike = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 60, 2)]
    assert sum(0.8 <= x < 0.85 for x in alike) == 10 and sum(x < 0.8 for x in alike) == 10
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs(spark, rows), SF).collect()}
    assert kept == {i for i, root in groups(rows, 80).items() if i == root}
    assert {i for i in range(1, 60, 2) if i not in kept} == {2 * k + 1 for k, x in enumerate(alike) if x >= 0.8}


def test_stages_on_odd_rows(spark, tmp_path):
    rows = ODD + [(1, "same words in two rows of one id"), (1, "same words in two rows of one id"), (2, "other words")]
    frame, sf = docs(spark, rows), str(tmp_path)
    spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    kept = frame
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, sf)
        assert kept.columns == frame.columns
    # One row of a repeated id stays; a row without an id is never lost.
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == sorted(
        str(i) for i in [None, 1, 2, 900, 901, 902, 903, 904, 905])
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs(spark, []), sf).count() == 0


def test_run_takes_a_key_and_removes_its_tables(spark):
    def staged():
        root = shared_path(spark, "llm").removeprefix("file:")
        return set(os.listdir(root)) if os.path.isdir(root) else set()

    before, texts = staged(), {}
    for key in (pii.DEMO_KEY, b"another key"):
        texts[key] = {r["doc_id"]: r["decoded"] for r in corpus_pipeline.run(spark, SF, key).collect()}
    left = staged() - before
    # The documents of the last stage, which its result reads, one for each run.
    assert sorted(name.rpartition("-")[0] for name in left) == ["pipeline-pseudonymise"] * 2
    one, other = texts.values()
    assert one.keys() == other.keys() and 0 < sum(one[i] != other[i] for i in one) < len(one) / 2


def test_stages_judge_rows_and_not_ids(spark, tmp_path):
    rng, sf = random.Random(8), str(tmp_path)
    one, two, item = (" ".join(sentences(rng, 60)) for _ in range(3))
    bad = [" ".join(["vile", *sentences(rng, 20)]) for _ in range(60)]
    good = [" ".join(["kind", *sentences(rng, 20)]) for _ in range(60)]
    labelled = [(100 + k, t) for k, t in enumerate(bad)] + [(200 + k, t) for k, t in enumerate(good)]
    spark.createDataFrame([(i, 5 * (i >= 200), int(i < 200)) for i, _ in labelled],
                          "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    def left(step, rows):
        frame = docs(spark, rows).withColumn("n", F.lit(1))
        out = step(spark, frame, sf)
        assert out.columns == frame.columns
        return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)

    mixed = [(None, bad[0]), (None, good[0]), (7, bad[1]), (7, good[1])]
    assert {r for r in left(corpus_pipeline.toxicity, labelled + mixed) if r[0] in (None, 7)} == {mixed[1], mixed[3]}
    mixed = [(None, item), (None, one), (7, item), (7, one)]
    assert left(corpus_pipeline.decontaminate, mixed) == sorted([mixed[1], mixed[3]], key=str)
    # Two texts of id 5, one also in upper case and the other twice, which id 3 has too.
    mixed = [(5, one), (5, two), (5, two), (5, one.upper()), (6, one), (9, two), (8, None), (8, ""), (8, None)]
    kept = left(corpus_pipeline.near_duplicates, mixed)
    assert kept in [sorted([(5, x), (5, two), (8, None), (8, "")], key=str) for x in (one, one.upper())]
    kept = left(corpus_pipeline.near_duplicates, [*mixed, (3, two)])
    assert kept in [sorted([(5, x), (3, two), (8, None), (8, "")], key=str) for x in (one, one.upper())]


def test_package_works_without_the_subpackage(tmp_path):
    """As the driver checks it: the folders and the pipeline deleted."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for p in ("__spark_entry__.py", "tunnelscan"):
        src = os.path.join(root, p)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, str(tmp_path / p))
    shutil.rmtree(tmp_path / "tunnelscan" / "llm")
    code = ("import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and 'flagged_messages' in q; "
            "assert not any(k.startswith('op') for k in e.oracle_sql())")
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-1000:]
