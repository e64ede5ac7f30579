import os

import duckdb
import pytest

from support import SF_SMALL, explain
from tunnelscan.plans import fixtures, queries as Q, scoring

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["key", "payload"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


SMALL_CONFIG = Q.FIXTURE_CONFIG.with_(min_group_count=4)


def test_results_do_not_depend_on_the_broadcast_bound(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    a = scoring.score(msgs, Q._stand_in, SMALL_CONFIG)
    b = scoring.score(msgs, Q._stand_in, SMALL_CONFIG, max_broadcast_rows=0)
    assert a.scored.columns == b.scored.columns and "count" in a.scored.columns
    scored = ["key", "QNAME", "count", "prediction", "subdomain_entropy"]
    assert 0 < a.scored.count() < a.candidates.count()
    assert _sorted(a.scored.select(*scored)) == _sorted(b.scored.select(*scored))
    assert _sorted(a.counts()) == _sorted(b.counts())
    assert a.alerts.count() > 0 and _sorted(a.alerts) == _sorted(b.alerts.select(*a.alerts.columns))
    assert _sorted(a.output.select("key")) == _sorted(b.output.select("key"))


def test_only_thin_rows_are_shuffled_for_the_gate(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    plan = explain(scoring.score(msgs, Q._stand_in, SMALL_CONFIG, max_broadcast_rows=0).scored, "extended")
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and not any("wirelen" in line or "authority" in line for line in read)


def test_flagged_rows_with_their_predictions(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    res = scoring.score(msgs, Q._stand_in, SMALL_CONFIG)
    rows = res.flagged_scored.select("key", "QNAME", "label_str", "prediction", "tunnel_perc", "alert_id", "count")
    assert rows.count() == res.flagged.count() > 0
    assert {r["label_str"] for r in rows.collect()} == {"normal", "tunnel"}


def test_scoring_plan_shape(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    res = scoring.score(msgs, Q._stand_in, Q.FIXTURE_CONFIG)
    out_plan = explain(res.output)
    # Flagged rows: scan -> explode -> broadcast lookups -> broadcast alert join; no shuffle.
    assert "Exchange" not in out_plan.replace("BroadcastExchange", "")
    assert "PushedFilters: [IsNotNull(payload.header.QR)" in out_plan
    scored_plan = explain(res.scored)
    assert "BatchEvalPython" not in scored_plan


def test_interval_plan_single_key_exchange(spark):
    gated = Q.volume_gate(Q._candidates(spark, SF_SMALL), 5)
    plan = explain(Q.interval_stats(gated), "simple")
    # Dedupe on (keys, bucket, ts); (keys, bucket) serves the inner window and its
    # aggregate; keys serves the cross-bucket window and the final aggregate.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("Window [lag") == 2


def _oracle_names():
    from tunnelscan.plans.oracle import oracle_sql
    return sorted(oracle_sql())


def _norm(v):
    from decimal import Decimal
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "pages", "labels", "customer", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", _oracle_names())
def test_query_matches_oracle_small(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    ours = sorted(repr([_norm(r[c]) for c in cols]) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    theirs = sorted(repr([_norm(row[i]) for i in idx]) for row in rel.fetchall())
    assert ours == theirs




def test_arrow_udf_runs_without_package_on_worker_path(tmp_path):
    """Executors need not have this package importable (driver runs elsewhere)."""
    import subprocess
    import sys
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "import __spark_entry__ as E\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "df = E.queries()['document_answer_features'](s, %r)\n"
        "print('SUM', df.agg({'average_answer_entropy': 'sum'}).first()[0])\n" % (ROOT, SF_SMALL))
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=600, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr[-2000:]
    assert "SUM " in out.stdout and float(out.stdout.split("SUM ")[1].split()[0]) > 0
