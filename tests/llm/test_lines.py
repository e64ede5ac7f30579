import hashlib
import random

import pytest
from helpers import ODD, docs, lower
from support import explain

from tunnelscan.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=10):
    """Rows (id, n_lines, n_dropped, digest of the kept text), by the definition."""
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = {}
    for i, lines in split:
        for x in lines:
            key = lower(x.strip(SPACE))
            if i is not None and len(key) >= min_chars:
                holders.setdefault(key, set()).add(i)
    out = []
    for i, lines in split:
        kept = [x for x in lines if i is None or not (len(h := holders.get(lower(x.strip(SPACE)), ())) > 1 and i > min(h))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in df.collect()), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    pool = [f"{rng.choice(['', ' ', chr(9)])}line number {rng.choice('ÄÖxyZ')}{k} {'w' * (k % 4)}{rng.choice(['', chr(13), '  '])}"
            for k in range(60)] + ["short", "nine char", "ten chars!", "TEN CHARS!", "", "   ", " ten chars! "]
    return [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 12)))) for i in range(n)]


def test_lines_equal_brute_force(spark):
    for seed in range(3):
        rows = corpus(seed)
        random.Random(seed).shuffle(rows)
        got = found(line_dedup.op11_line_dedup(docs(spark, rows)))
        assert got == brute(rows) and any(r[2] for r in got)


def test_odd_rows_ties_and_repeated_ids(spark):
    shared = "one and the same line of text"
    rows = ODD + [(5, f"{shared}\n{shared}\nown line"), (5, f"other\n{shared}"), (5, f"other\n{shared}"), (9, shared),
                  (7, f"\n{shared.upper()} \n\n tail of it\n"), (None, shared), (None, shared), (8, "\n\n"), (6, "x\r\n" * 3)]
    rows += [(20, "\n".join(f"line {k // 2} of the long text" for k in range(20_000))),
             (21, "\n".join(f"line {k} of the long text" for k in range(0, 20_000, 3)))]
    assert found(line_dedup.op11_line_dedup(docs(spark, rows))) == brute(rows)
    assert found(line_dedup.op11_line_dedup(docs(spark, []))) == []
    assert found(line_dedup.op11_line_dedup(docs(spark, [(1, None), (2, None)]))) == brute([(1, None), (2, None)])


@pytest.mark.parametrize("share", [0.5, 0.01, 0.0005])
def test_hot_lines_go_another_way_to_the_same_result(spark, share):
    rows = [(i, f"very common line of all\n{t}" if i % 3 else t) for i, t in corpus(9, 400)]
    frame = docs(spark, rows)
    at = {(r["doc_id"], x) for r in line_dedup.keep_bitmaps(frame, hot_share=share).collect()
          for start, n in r["dropped"] for x in range(start, start + n)}
    want = {(r["doc_id"], x) for r in line_dedup.keep_bitmaps(frame).collect()
            for start, n in r["dropped"] for x in range(start, start + n)}
    assert at == want and sum(1 for i, x in at if x == 0) >= 266
    assert sum(r[2] for r in brute(rows)) == len(at)


def test_runs_are_short_and_texts_stay_out_of_the_shuffles(spark):
    block = "\n".join(f"line {k} of a block in both" for k in range(500))
    frame = docs(spark, [(1, block), (2, f"head of the second\n{block}\ntail of the second")])
    (row,) = line_dedup.keep_bitmaps(frame).collect()
    assert (row["doc_id"], row["n_dropped"], [tuple(r) for r in row["dropped"]]) == (2, 500, [(1, 500)])
    plan = explain(line_dedup.keep_bitmaps(frame))
    assert "rangepartitioning(h1" in plan and "Python" not in plan and "Arrow" not in plan
    # The window reads the range partitions as they are: the one exchange by the
    # hash is that of the hot lines' minimum.
    assert plan.count("hashpartitioning(h1") == 1
