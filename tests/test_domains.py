from pyspark.sql import functions as F
from support import explain

from tunnelscan.functions.idn import ascii_label, ascii_name
from tunnelscan.operators.domains import (
    default_suffix_rules,
    drop_reverse_lookups,
    parse_suffix_lines,
    read_suffix_rules,
    registrable_domain,
    rules_from_pairs,
)

# SURVEY 2.11: expected results with the FIXTURES section 4 rule set.
CASES = [
    ("a.b.example.co.uk.", "example.co.uk"),
    ("X.Example.com", "example.com"),
    ("4.3.2.1.in-addr.arpa.", "1.in-addr.arpa"),
    ("co.uk", None), ("com.", None), ("localhost", None), (".", None), ("", None),
    ("a.b.foo.ck", "b.foo.ck"), ("foo.ck", None), ("ck", None),
    ("x.www.ck.", "www.ck"), ("www.ck", "www.ck"),
    (None, None),
]


def _domains(spark, names, **kw):
    df = spark.createDataFrame([(n,) for n in names], "QNAME string")
    return [r["2ld"] for r in registrable_domain(df, "QNAME", **kw).collect()]


def test_survey_table_static_rules(spark):
    assert _domains(spark, [c for c, _ in CASES]) == [e for _, e in CASES]


def test_survey_table_user_rules(spark):
    # The same rules given as a table take the materialised path.
    got = _domains(spark, [c for c, _ in CASES], rules=default_suffix_rules(spark))
    assert got == [e for _, e in CASES]


def test_public_suffix_list_text(spark):
    text = ["// comment", "", "com", "co.uk", "*.ck", "!www.ck", "uk  // trailing", "Arpa"]
    rules = parse_suffix_lines(spark.createDataFrame([(t,) for t in text], "value string"))
    got = sorted(tuple(r) for r in rules.collect())
    assert got == sorted([("com", "exact"), ("co.uk", "exact"), ("ck", "wildcard"),
                          ("www.ck", "exception"), ("uk", "exact"), ("arpa", "exact")])
    assert _domains(spark, ["a.b.foo.ck", "x.www.ck"], rules=rules) == ["b.foo.ck", "www.ck"]


def test_fallback_and_preserve_case(spark):
    assert _domains(spark, ["a.b.localhost.", "localhost"], fallback_last_label=True) == ["b.localhost", None]
    assert _domains(spark, ["q.EXAMPLE.com."], preserve_case=True) == ["EXAMPLE.com"]


def test_unlisted_suffixes_are_kept_with_the_built_in_rules(spark):
    names = ["a.evil.io.", "b.evil.de.", "c.evil.com.", "d.evil.co.uk.", "com."]
    assert _domains(spark, names) == ["evil.io", "evil.de", "evil.com", "evil.co.uk", None]
    # A user's table is complete unless said otherwise.
    rules = rules_from_pairs(spark, [("com", "exact")])
    assert _domains(spark, names, rules=rules) == [None, None, "evil.com", None, None]
    assert _domains(spark, names, rules=rules, fallback_last_label=True)[0] == "evil.io"


def test_longest_match_wins(spark):
    rules = rules_from_pairs(spark, [("uk", "exact"), ("co.uk", "exact"), ("a.b.c.co.uk", "exact")])
    assert _domains(spark, ["x.a.b.c.co.uk", "x.y.co.uk", "x.uk"], rules=rules) == \
        ["x.a.b.c.co.uk", "y.co.uk", "x.uk"]


def test_reverse_lookup_filter_drops_null(spark):
    df = spark.createDataFrame([("a",), ("1.in-addr.arpa",), (None,)], "`2ld` string")
    assert [r[0] for r in drop_reverse_lookups(df).collect()] == ["a"]


def test_domain_plan_has_no_shuffle(spark):
    df = spark.createDataFrame([("a.example.com.",)], "QNAME string")
    plan = explain(registrable_domain(df, "QNAME"))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_random_names_match_python_model(spark):
    import random
    from pymodel import registrable
    rules = [("com", "exact"), ("uk", "exact"), ("co.uk", "exact"), ("ck", "wildcard"),
             ("www.ck", "exception"), ("jp", "exact"), ("kobe.jp", "wildcard"), ("city.kobe.jp", "exception"),
             ("a.b.c", "exact"), ("b.c", "wildcard"), ("net", "exact"), ("net", "wildcard")]
    rng = random.Random(5)
    pool = ["com", "uk", "co", "ck", "www", "jp", "kobe", "city", "a", "b", "c", "net", "x", "Y", ""]
    names = []
    for _ in range(600):
        labels = [rng.choice(pool) for _ in range(rng.randint(1, 6))]
        names.append(".".join(labels) + rng.choice(["", "."]))
    names += [None, ".", "", "..", "a..com"]
    for fallback in (False, True):
        got = _domains(spark, names, rules=rules_from_pairs(spark, rules), fallback_last_label=fallback)
        want = [registrable(n, rules, fallback) for n in names]
        bad = [(n, g, w) for n, g, w in zip(names, got, want) if g != w]
        assert not bad, bad[:5]


LIST = """// header comment
net
// ===BEGIN ICANN DOMAINS===

// xn--55qx5d.cn
公司.cn
cn
рф\r
*.川崎.jp
!city.川崎.jp
// ===END ICANN DOMAINS===
org
// ===BEGIN PRIVATE DOMAINS===
blogspot.com
com
// ===END PRIVATE DOMAINS===
"""


def _written(spark, tmp_path):
    (tmp_path / "list.dat").write_bytes(LIST.encode())
    return str(tmp_path / "list.dat")


def test_sections_of_a_suffix_list(spark, tmp_path):
    rules = read_suffix_rules(spark, _written(spark, tmp_path))
    assert {(r["suffix"], r["kind"], r["section"]) for r in rules.collect()} == {
        ("net", "exact", None), ("公司.cn", "exact", "icann"), ("cn", "exact", "icann"), ("рф", "exact", "icann"),
        ("川崎.jp", "wildcard", "icann"), ("city.川崎.jp", "exception", "icann"), ("org", "exact", None),
        ("blogspot.com", "exact", "private"), ("com", "exact", "private")}
    icann = read_suffix_rules(spark, _written(spark, tmp_path), private=False)
    assert {r["suffix"] for r in icann.collect()} == {"net", "公司.cn", "cn", "рф", "川崎.jp", "city.川崎.jp", "org"}


def test_internationalised_names_split_by_coded_rules(spark, tmp_path):
    rules = read_suffix_rules(spark, _written(spark, tmp_path))
    cases = [("a.b.xn--55qx5d.cn.", "b.xn--55qx5d.cn"), ("a.B.公司.cn", "b.公司.cn"), ("公司.cn", None),
             ("XN--55QX5D.CN", None), ("x.y.рф", "y.рф"), ("x.y.xn--p1ai.", "y.xn--p1ai"), ("x.y。РФ。", "y.рф"),
             ("a.b.c.川崎.jp", "b.c.川崎.jp"), ("a.city.xn--8ltrs.jp", "city.xn--8ltrs.jp"), ("me.blogspot.com", "me.blogspot.com"),
             ("例え.org", "例え.org"), ("é" * 70 + ".y.net", "y.net"), ("a..рф", ".рф"), (None, None), ("", None)]
    names = [n for n, _ in cases]
    assert _domains(spark, names, rules=rules) == [d for _, d in cases]
    coded = spark.createDataFrame([(n,) for n in names], "n string").select(ascii_name(F.col("n")).alias("QNAME"))
    got = [r["2ld"] for r in registrable_domain(coded, "QNAME", rules).collect()]
    assert got[:7] == ["b.xn--55qx5d.cn"] * 2 + [None] * 2 + ["y.xn--p1ai"] * 3


def test_coding_equals_an_independent_one(spark):
    import random
    rng = random.Random(2)
    letters = "abcxyz09-äöüéñßçøłžšđабвгдежαβγδ公司例え川崎中国"
    labels = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))).strip("-") or "a" for _ in range(400)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "x string").select(ascii_label(F.col("x"))).collect()]
    want = [x if x.isascii() else x.encode("idna").decode() for x in labels]
    assert got == want


def test_both_spellings_are_one_domain_in_the_job(spark, tmp_path):
    from tunnelscan.plans import scoring
    from tunnelscan.schemas import DNS_MESSAGE_SCHEMA
    rules = read_suffix_rules(spark, _written(spark, tmp_path))
    rows = [(str(k), {"header": {"QR": True, "responseCode": "NOERROR"}, "questions": [{"name": n}],
                      "ip": {"srcIP": "10.0.0.1", "destIP": "192.0.2.1"}, "pcap": {"ts_sec": k}})
            for k, n in enumerate(["a.b.公司.cn.", "c.b.xn--55qx5d.cn."])]
    msgs = spark.createDataFrame(rows, DNS_MESSAGE_SCHEMA)
    assert {r["2ld"] for r in scoring.prepare(msgs, rules).collect()} == {"b.公司.cn", "b.xn--55qx5d.cn"}
    assert {r["2ld"] for r in scoring.prepare(msgs, rules, ascii_names=True).collect()} == {"b.xn--55qx5d.cn"}
