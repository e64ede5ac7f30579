"""Print the formatted physical plans of the scoring job's main DataFrames
(run: python tools/plans.py [sf_dir])."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def explain(df, mode="formatted") -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tunnelscan.session import local_session
    from tunnelscan.plans import fixtures, queries as Q, scoring
    from tunnelscan.operators.gate import busy_groups
    from tunnelscan.operators.verdict import interval_stats
    spark = local_session(8, 16)
    res = scoring.score(fixtures.read_staged_dns_log(spark, sf), Q._stand_in, Q.FIXTURE_CONFIG)
    sections = [
        ("Volume gate: busy groups (O-31, O-32)", busy_groups(res.candidates, Q.FIXTURE_CONFIG.min_group_count)),
        ("Scored rows: gate join, features, labeler (O-28, O-41..O-53, O-64)", res.scored),
        ("Group aggregate with exact distinct count (O-34..O-38)", scoring.group_stats(res.scored)),
        ("Flagged messages (O-30, O-27)", res.output),
        ("Interval statistics (O-39)", interval_stats(res.scored)),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/plans.py` on `{sf}` (local[8]). Thin tables that are",
           "materialised (busy groups, suspicious groups, alerts) appear as `Scan ExistingRDD`",
           "or `LogicalRDD` leaves: they were written to the checkpoint folder and counted",
           "before being broadcast.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", explain(df).strip(), "```", ""]
    print("\n".join(out))


if __name__ == "__main__":
    main()
