import datetime
import hashlib
import ipaddress
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import ODD, docs, item_words, sentences
from tokenizers import Tokenizer

from tunnelscan.llm import decontaminate, licenses, pii, token_counts
from tunnelscan.llm.license_texts import NAMES, NOTICES


def contamination(rows, items, window=13):
    windows = {}
    for item, text in items:
        w = item_words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    sizes, out = {len(g) for g in windows}, {}
    for i, text in rows:
        w, hit, found = item_words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                  bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 150, 30])
def test_decontamination_equals_brute_force(spark, block_words):
    rng = random.Random(5)
    items = [(k, " ".join(sentences(rng, rng.choice([3, 13, 14, 40])))) for k in range(12)]
    items += [(12, items[0][1]), (13, "Short, item!"), (14, ""), (15, None), (2, items[2][1])]
    rows = []
    for k in range(40):
        w = sentences(rng, rng.randint(0, 300))
        if k % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = re.sub(r"\W", " , ", rng.choice(items[:13])[1]).upper().split()
        rows.append((k, "; ".join(w)))
    rows += [(50, "a SHORT item."), *ODD[1:]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.decontaminate(docs(spark, rows), bench, block_words=block_words)
    want, texts = contamination(rows, items), dict(rows)
    for r in found.collect():
        assert (r["n_words"], r["n_hit"], len(r["items"]), r["items_sha256"]) == want[r["doc_id"]][:4]
        inside = sum(len(item_words(texts[r["doc_id"]][a:b])) for a, b in zip(r["starts"], r["ends"]))
        assert inside == r["n_hit"]
    out = decontaminate.op3_decontaminate(docs(spark, rows), bench)
    assert {r["doc_id"]: r["contaminated"] for r in out.collect()} == {i: v[4] for i, v in want.items()}
    assert any(v[4] for v in want.values())


@pytest.mark.parametrize("block_words", [1_000_000, 1])
def test_items_without_an_id_hit_too(spark, block_words):
    bench = spark.createDataFrame([(None, "one two three"), (None, "four five"), (7, "four five")],
                                  "item_id long, text string")
    rows = [(1, "x one two three"), (2, "four five y"), (3, "one two x three")]
    found = decontaminate.decontaminate(docs(spark, rows), bench, block_words=block_words)
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in found.collect()} == {1: (3, []), 2: (2, ["7"]), 3: (0, [])}
    out = {r["doc_id"]: r for r in decontaminate.op3_decontaminate(docs(spark, rows), bench).collect()}
    assert [out[k]["contaminated"] for k in (1, 2, 3)] == [True, True, False] and out[1]["n_items"] == 0


def test_the_scan_finds_every_window_and_no_other():
    rng = random.Random(11)
    vocabulary = [b"w%d" % k for k in range(40)]
    # Frequent words, so that windows share beginnings and short ones lie in long ones.
    draw = lambda n: [vocabulary[min(39, int(rng.paretovariate(0.7)) - 1)] for _ in range(n)]
    items = [(str(k), draw(rng.choice([1, 2, 5, 13, 20, 60]))) for k in range(60)] + [(None, draw(30))]
    auto = decontaminate.packed(pa.array([i for i, _ in items], pa.string()),
                                pa.array([w for _, w in items], pa.list_(pa.binary())), 13)
    number = {w: k for k, w in enumerate(auto["words"].tobytes().split(), 1)}
    windows = {tuple(w[k:k + 13]) for _, w in items for k in range(max(1, len(w) - 12))}
    assert len(windows) == len(auto["ends"])
    for size in (0, 1, decontaminate.LANE, 3 * decontaminate.LANE + 7):
        text = draw(size // 2)
        while len(text) < size:
            text += rng.choice(items)[1] + draw(3)
        text = text[:size]
        want = {(k, n) for n in {len(w) for w in windows} for k in range(len(text)) if tuple(text[k:k + n]) in windows
                and k + n <= len(text)}
        end, state = decontaminate.scan(auto, np.array([number.get(w, 0) for w in text], np.int32))
        found = [(e - n + 1, n) for e, n in zip(end.tolist(), auto["size"][state].tolist())]
        assert sorted(found) == sorted(want)


def test_items_longer_than_a_piece_and_shared_windows(spark):
    rng = random.Random(3)
    words = [f"word{rng.randrange(10**6)}" for _ in range(3 * decontaminate.PIECE)]
    cut = decontaminate.PIECE - 5
    items = [(1, " ".join(words)), (2, " ".join(words[cut:cut + 13])), (None, " ".join(words[:20]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, " ".join(words[cut:cut + 13])), (2, " ".join(words[cut:cut + 12])), (3, " ".join(words))]
    want = contamination(rows, [(i, t) for i, t in items if i is not None])
    for block_words in (decontaminate.BLOCK_WORDS, 5000):
        found = decontaminate.decontaminate(docs(spark, rows), bench, block_words=block_words)
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"]), r["items_sha256"]) for r in found.collect()} == {
            i: v[:4] for i, v in want.items()}


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.op3_decontaminate(docs(spark, ODD), none).collect()
    assert len(out) == len(ODD) and not any(r["contaminated"] for r in out)
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.op3_decontaminate(docs(spark, []), some).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, tmp_path, name):
    path, rng = public_tokenizers.path(name), random.Random(1)
    odd = "é́ İstanbul ΣΑΣ don't I'M <|endoftext|>x <|startoftext|> \x1c \x85   a b 12 3.5 😀 x'LL ﬁ"
    rows = [(k, t) for k, t in ODD] + [(1, odd), (2, odd), (2, odd)]
    rows += [(10 + k, "".join(rng.choice(list(odd) + ["\n", "\t", " "]) for _ in range(rng.randint(1, 80)))) for k in range(40)]
    cache = str(tmp_path / "cache")
    out = token_counts.token_counts(docs(spark, rows), path, cache)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in out.collect()), key=str)
    with open(path, "rb") as f:
        data = f.read()
    count = token_counts.load(data, name.rpartition(".")[2])
    want = sorted(((i, len((t or "").encode()), count([t or ""])[0]) for i, t in rows), key=str)
    assert got == want
    if name.endswith("json"):
        plain = Tokenizer.from_file(path)
        assert {i: n for i, _, n in got if i is not None} == {
            i: len(plain.encode(t or "", add_special_tokens=False).ids) for i, t in rows if i is not None}


def test_only_misses_are_encoded_and_appended(spark, tmp_path):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    rows = [(1, "some text"), (2, "some text"), (3, "other text")]
    token_counts.op6_token_counts(docs(spark, rows), path, cache).collect()
    assert spark.read.parquet(cache).count() == 2
    out = token_counts.op6_token_counts(docs(spark, rows + [(4, "new"), (5, None)]), path, cache)
    assert {r["doc_id"]: r["n_tokens"] for r in out.collect()} == {1: 2, 2: 2, 3: 2, 4: 1, 5: 0}
    assert spark.read.parquet(cache).count() == 4
    # Another tokenizer shares the table, not the entries.
    token_counts.op6_token_counts(docs(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), cache).collect()
    assert spark.read.parquet(cache).count() == 6


def test_normalised_copies_share_a_digest_and_are_encoded_once(spark, tmp_path):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    same = ["Some  text,\nof WORDS", "some text, of words", "\tsome TEXT,\r\n\x0bof words  "]
    rows = [(None, t) for t in same * 3] + [(5, same[0])] * 3
    # Not the same: another white space, other letters, a special token's sign.
    rows += [(6, "some\u00a0text, of words"), (7, "J\u030c"), (8, "j\u030c"), (9, "<|ENDOFTEXT|>"), (10, "<|endoftext|>")]
    out = token_counts.token_counts(docs(spark, rows), path, cache).collect()
    plain = Tokenizer.from_file(path)
    given = {i: t for i, t in rows}
    assert {(r["doc_id"], r["n_tokens"]) for r in out} == {
        (i, len(plain.encode(t, add_special_tokens=False).ids)) for i, t in given.items()}
    assert sorted(r["n_bytes"] for r in out) == sorted(len(t.encode()) for _, t in rows)
    assert spark.read.parquet(cache).count() == 6 and len({bytes(r["digest"]) for r in out}) == 6
    # Another version of the library would not find these entries.
    versions = {r["version"] for r in spark.read.parquet(cache).collect()}
    with open(path, "rb") as f:
        data = f.read()
    assert versions == {token_counts.version_digest(data, "json")} != {hashlib.sha256(data).hexdigest()}


def test_normalising_never_changes_a_count():
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(3)
    with open(path, "rb") as f:
        data = f.read()
    assert token_counts.lower_cases(data, "json") and not token_counts.splits_at_space(data, "model")
    count = token_counts.load(data, "json")
    letters = list("aBcIJ'sLL12.,<|>-") + [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    plain = [re.sub("[ \t-\r]+", " ", t).strip(" ") for t in texts]
    plain = [p if "<|" in t else p.lower() for p, t in zip(plain, texts)]
    assert count(plain) == count(texts)


def test_compacted_cache_holds_each_entry_once(spark, tmp_path):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    for k in range(3):
        token_counts.op6_token_counts(docs(spark, [(k, f"text number {k}")]), path, cache).collect()
    entries = spark.read.parquet(cache)
    entries.write.mode("append").parquet(cache)
    want = sorted((bytes(r["digest"]), r["n_tokens"]) for r in spark.read.parquet(cache).distinct().collect())
    token_counts.compact(spark, cache)
    assert sorted((bytes(r["digest"]), r["n_tokens"]) for r in spark.read.parquet(cache).collect()) == want and len(want) == 3
    assert token_counts.op6_token_counts(docs(spark, [(9, "TEXT number 1 ")]), path, cache).first()["n_tokens"] == 3
    assert spark.read.parquet(cache).count() == 3


P = pii.Permutation(b"test key")
VALUES = {
    "email": ["Jo.Doe_7@mail.example.com", "x@y.org"],
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "3400 000000 00009"],
    "ssn": ["123-45-6789"],
    "ip": ["10.0.0.255", "8.8.8.8"],
    "date": ["2021-02-28", "31.12.1999", "02/03/2004", "25/12/2010", "1/2/2003", "1.2.2003"],
    "phone": ["+1 (017) 555-7713", "+49 30 1234567", "(212) 555-0100", "212-555-0100"],
    "iban": ["GB82WEST12345698765432", "DE89370400440532013000"],
    "secret": ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "Zx81-abc_DEF0123456789"],
}


def wrap(kind, value):
    return f'say: token = "{value}", thanks' if kind == "secret" else f"say {value}, thanks."


@pytest.mark.parametrize("kind, value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_pseudonyms_keep_the_format_and_come_back(kind, value):
    text = wrap(kind, value)
    new, found = pii.pseudonyms(text, P)
    assert [(k, text[a:b]) for k, a, b in found] == [(kind, value)]
    changed = pii.pseudonyms(new, P)[1]
    assert [k for k, _, _ in changed] == [kind]
    assert new != text
    if kind != "ip":
        shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
        assert shape(new) == shape(text) or kind == "secret"
        assert len(new) == len(text)
    assert pii.pseudonyms(new, P, inverse=True)[0] == text
    assert pii.pseudonyms(text, P)[0] == new != pii.pseudonyms(text, pii.Permutation(b"other key"))[0]


@pytest.mark.parametrize("text, kind, value", [
    ("paid in 2024 4111 1111 1111 1111 today", "card", "4111 1111 1111 1111"),
    ("items 1234 5678 9012 2024 5500-0000-0000-0004.", "card", "5500-0000-0000-0004"),
    ("+4111 1111 1111 1111", "card", "4111 1111 1111 1111"),
    ("to GB82 WEST 1234 5698 7654 32.", "iban", "GB82 WEST 1234 5698 7654 32"),
    ("to BE68 5390 0754 7034 THIS YEAR", "iban", "BE68 5390 0754 7034"),
    ("to NO93 8601 1117 947 or", "iban", "NO93 8601 1117 947"),
    ("ref AB12 DE89 3704 0044 0532 0130 00", "iban", "DE89 3704 0044 0532 0130 00"),
])
def test_values_within_failed_ones_and_in_groups(text, kind, value):
    new, found = pii.pseudonyms(text, P)
    assert [(k, text[a:b]) for k, a, b in found] == [(kind, value)]
    assert value not in new and len(new) == len(text) and pii.pseudonyms(new, P, inverse=True)[0] == text
    # The value alone has the same pseudonym, with and without its groups.
    assert pii.pseudonyms(value, P)[0] in new
    assert kind != "iban" or pii.pseudonyms(value.replace(" ", ""), P)[0] == pii.pseudonyms(value, P)[0].replace(" ", "")
    assert kind != "iban" or pii.pseudonyms(value[:-1] + ("1" if value[-1] != "1" else "2"), P)[1] == []


@pytest.mark.parametrize("letters", ["0123456789abcdef", "0123456789", "ABCDEF0123456789", "abcXYZ019+/_-"])
@pytest.mark.parametrize("n", [127, 128, 129, 300, 5_000, 10_000])
def test_long_secrets_come_back_and_stay_linked(letters, n):
    rng = random.Random(n)
    value = "".join(rng.choice(letters) for _ in range(n))
    text = f"key={value} end"
    new, found = pii.pseudonyms(text, P)
    assert found == [("secret", 4, 4 + n)] and len(new) == len(text) and pii.pseudonyms(new, P, inverse=True)[0] == text
    classes = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
    assert classes(new) == classes(text) or "f" in letters.lower()
    # Equal values are linked; a change anywhere changes every block.
    assert pii.pseudonyms(f"other text, secret: {value}", P)[0].endswith(new[4:4 + n])
    other = value[:-1] + ("1" if value[-1] != "1" else "0")
    if classes(other) == classes(value):
        far = pii.pseudonyms(f"key={other} end", P)[0]
        assert all(far[4 + k:4 + k + 40] != new[4 + k:4 + k + 40] for k in range(0, n - 40, pii.BLOCK))


def test_a_secret_of_a_megabyte_takes_linear_time():
    value = "".join(random.Random(3).choice("0123456789abcdef") for _ in range(1 << 20))
    began = time.process_time()
    new, found = pii.pseudonyms(f"token: {value}", P)
    assert time.process_time() - began < 5 and len(found) == 1 and value not in new


def test_digits_of_other_scripts_stay():
    for text in ("٢٠٢١-٠٢-٢٨", "١٢٣-٤٥-٦٧٨٩", "call ٢١٢-٥٥٥-٠١٠٠", "٤١١١١١١١١١١١١١١١", "१०.०.०.२५५"):
        assert pii.pseudonyms(text, P) == (text, []), text


def test_findings_equal_those_of_a_plain_reading():
    """Texts of single words, each read by Python's own parsers."""
    rng = random.Random(12)

    def checksum(digits):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10

    def made():
        kind = rng.choice(["card", "ssn", "ip", "date", "iban", "email", "word"])
        if kind == "card":
            return "".join(rng.choice("0123456789") for _ in range(rng.randrange(12, 21)))
        if kind == "ssn":
            return f"{rng.choice(['000', '123', '666', '899', '900'])}-{rng.choice(['00', '12'])}-{rng.choice(['0000', '4321'])}"
        if kind == "ip":
            return ".".join(str(rng.choice([0, 7, 255, 256, 999])) for _ in range(4))
        if kind == "date":
            return f"{rng.choice(['1899', '1900', '2024', '2099', '2100'])}-{rng.randrange(14):02d}-{rng.randrange(33):02d}"
        if kind == "iban":
            account = "".join(rng.choice("0123456789") for _ in range(18))
            check = 98 - int(account + "131400") % 97 if rng.random() < 0.5 else rng.randrange(100)
            return f"DE{check:02d}{account}"
        return "jo.doe@mail.example.com" if kind == "email" else rng.choice(["jo@", "@home", "plain", "v1.2.3", "12345"])

    def plain(word):
        if re.fullmatch("[0-9]{13,19}", word):
            return "card" if checksum(word) == 0 and word.strip("0") else None
        if m := re.fullmatch("([0-9]{3})-([0-9]{2})-([0-9]{4})", word):
            return "ssn" if 0 < int(m[1]) < 900 and int(m[1]) != 666 and int(m[2]) and int(m[3]) else None
        if re.fullmatch("[0-9]{4}-[0-9]{2}-[0-9]{2}", word):
            try:
                return "date" if 1900 <= datetime.date.fromisoformat(word).year <= 2099 else None
            except ValueError:
                return None
        if re.fullmatch("DE[0-9]{20}", word):
            return "iban" if int(word[4:] + "1314" + word[2:4]) % 97 == 1 else None
        try:
            return "ip" if str(ipaddress.IPv4Address(word)) == word else None
        except ValueError:
            return "email" if word.endswith("@mail.example.com") else None

    seen = set()
    for _ in range(1500):
        words = [made() for _ in range(rng.randrange(1, 6))]
        text, want, at = "", [], 0
        for k, word in enumerate(words):
            text += (" and " if k else "") + word
            if kind := plain(word):
                want.append((kind, len(text) - len(word), len(text)))
                seen.add(kind)
        assert pii.pseudonyms(text, P)[1] == want, text
    assert seen == {"card", "ssn", "ip", "date", "iban", "email"}


def test_only_valid_values_are_changed():
    for text in ("4111111111111112", "999.1.1.1", "2021-02-30", "000-12-3456", "version 2.0.1", "GB83WEST12345698765432",
                 "1234567", "a@b", "token = short", "01.02.03.04"):
        assert pii.pseudonyms(text, P) == (text, []), text


@pytest.mark.parametrize("size", [1, 2, 10, 97, 1000])
def test_permutation_is_one_to_one(size):
    image = [P.move("test", size, x) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert [P.move("test", size, y, inverse=True) for y in image] == list(range(size))


def test_dates_map_one_to_one_within_their_layout():
    first = datetime.date(2000, 1, 1).toordinal()
    days = [datetime.date.fromordinal(first + k).isoformat() for k in range(800)]
    assert len({pii.pseudonyms(d, P)[0] for d in days}) == len(days)


def test_equal_values_stay_linked_over_documents(spark):
    value = VALUES["card"][0]
    rows = [(k, f"x{k}y pays {value} now" if k % 2 else None) for k in range(6)] + ODD
    frame = docs(spark, rows)
    out = pii.pseudonymise(frame, b"k", found_col="found")
    assert out.columns == frame.columns + ["found"] and out.count() == frame.count()
    texts = [r["text"] for r in out.collect() if r["text"] and "pays" in r["text"]]
    assert len({t.split("pays")[1] for t in texts}) == 1 and value not in texts[0]
    same = dict(rows)
    assert all(r["text"] == same[r["doc_id"]] for r in out.collect() if r["doc_id"] in (900, 901, 902, 903, 904, 905))
    assert pii.op7_pii(docs(spark, [])).count() == 0


@pytest.mark.parametrize("license_id, text", NOTICES)
def test_notices_are_recognised_within_other_text(license_id, text):
    rng = random.Random(6)
    around = " ".join(sentences(rng, 60))
    all_of, alone = licenses.templates(), licenses.zstandard.ZstdCompressor(licenses.LEVEL)
    found = licenses.scan(f"{around}\n\n# {text.replace(chr(10), chr(10) + '# ')}\n\n{around}", all_of, alone)
    assert [f[2] for f in found] == [license_id] and found[0][4] == []
    w = text.split()
    w[len(w) // 2] = "altered"
    found = licenses.scan(" ".join(w), all_of, alone)
    assert [f[2] for f in found] == [license_id] and len(found[0][4]) <= 2


@pytest.mark.parametrize("license_id, text", NAMES)
def test_names_are_recognised_word_for_word(license_id, text):
    all_of, alone = licenses.templates(), licenses.zstandard.ZstdCompressor(licenses.LEVEL)
    found = licenses.scan(f"Some words.\nThis is {text}.\nMore words", all_of, alone)
    assert license_id in {f[2] for f in found}
    assert len({f[2] for f in found}) == 1
    assert not licenses.scan(f"Some words.\nThis is {text.split()[0]} and nothing.\nMore words", all_of, alone)


@pytest.mark.parametrize("lines", [0, 20, 40, 400, 2000])
def test_licences_in_blocks_of_any_length(lines):
    """A third-party-notice file: notices, one within another, and a name between lines of licence words."""
    rng = random.Random(lines)
    filler = [" ".join(["license", *sentences(rng, 8)]) for _ in range(lines)]
    held = dict(NOTICES)
    altered = held["MPL-2.0"].replace("distributed", "delivered")
    parts = [held["ISC"], "released under the mit license", held["BSD-3-Clause"], held["BSD-2-Clause"], altered]
    text = "\n".join(line for k, part in enumerate(parts) for line in [*filler[k::5], part]) + "\n" + "\n".join(filler)
    all_of, alone = licenses.templates(), licenses.zstandard.ZstdCompressor(licenses.LEVEL)
    assert len(licenses.blocks(text)) == 1 and (lines < 2000 or len(text) > 100_000)
    found = {f[2]: f for f in licenses.scan(text, all_of, alone)}
    assert set(found) == {"ISC", "MIT", "BSD-3-Clause", "BSD-2-Clause", "MPL-2.0"}
    assert [found[k][4] for k in ("ISC", "BSD-3-Clause", "BSD-2-Clause", "MPL-2.0")] == [[], [], [], ["distributed"]]
    assert all(text[a:b].lower().count("mit license") for a, b, k, *_ in found.values() if k == "MIT")


# Sentences as they stand in documents, none of them made from the templates.
STATEMENTS = [
    ("// SPDX-License-Identifier: MIT", {"MIT"}),
    ("/* SPDX-License-Identifier: Apache-2.0 */", {"Apache-2.0"}),
    ("# SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) AND ISC -- see below", {"GPL-2.0-only", "BSD-3-Clause", "ISC"}),
    ("<!-- spdx-license-identifier: LGPL-2.1+ WITH Linux-syscall-note -->", {"LGPL-2.1-or-later WITH Linux-syscall-note"}),
    ("SPDX-License-Identifier: LicenseRef-Our-Own or MIT", {"LicenseRef-Our-Own", "MIT"}),
    ("SPDX-License-Identifier:", set()),
    ("This is distributed under the GNU Lesser General Public License v2.1.", {"LGPL-2.1"}),
    ("It is under the GNU General Public License version 2 or later, like its parts.", {"GPL-2.0-or-later"}),
    ("GNU General Public License v. 3 only", {"GPL-3.0-only"}),
    ("the GNU Affero General Public License, version 3, or (at your option) any later version", {"AGPL-3.0-or-later"}),
    ("Subject to the Boost Software License 1.0 as it stands", {"BSL-1.0"}),
    ("made available under the Eclipse Public License 2.0", {"EPL-2.0"}),
    ("Licence: European Union Public Licence v. 1.2", {"EUPL-1.2"}),
    ("code licensed GPLv2? license: GPL v3, docs: GFDL 1.3", {"GPL-3.0", "GFDL-1.3"}),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 licence", {"CC-BY-NC-SA-4.0"}),
    ("photos: CC BY-SA 2.5 license", {"CC-BY-SA-2.5"}),
    ("the Apache Software License, Version 1.1", {"Apache-1.1"}),
    ("the New BSD License and the Simplified BSD License", {"BSD-3-Clause", "BSD-2-Clause"}),
    ("a license to speak, a gnu 2.0 and an Apache helicopter license 7", set()),
]


@pytest.mark.parametrize("text, want", STATEMENTS)
def test_statements_not_made_from_templates(text, want):
    all_of, alone = licenses.templates(), licenses.zstandard.ZstdCompressor(licenses.LEVEL)
    found = licenses.scan(f"First line of it.\n{text}\nLast line.", all_of, alone)
    assert {f[2] for f in found} == want
    assert all(a >= 18 and b <= 19 + len(text) for a, b, *_ in found)


def test_wordings_of_a_user(spark, tmp_path):
    own = "The bearer of this license may use the machine on Sundays, may lend it to neighbours, and shall return it clean and dry."
    (tmp_path / "notices").mkdir()
    (tmp_path / "notices" / "Sunday-1.0.txt").write_text(own)
    (tmp_path / "names").mkdir()
    (tmp_path / "names" / "House.txt").write_text("House License of 1901")
    more = licenses.read_wordings(spark, str(tmp_path / "notices")) + licenses.read_wordings(spark, str(tmp_path / "names"), exact=True)
    rows = [(1, "x\n" + own.replace("neighbours", "friends")), (2, "under the house licence of 1901"), (3, "MIT License")]
    got = {r["doc_id"]: (r["license_id"], r["missing"]) for r in licenses.scan_licenses(docs(spark, rows), more=more).collect()}
    assert got == {1: ("Sunday-1.0", ["neighbours"]), 2: ("House", []), 3: ("MIT", [])}
    (tmp_path / "notices" / "big.txt").write_text("x" * 100)
    limit, licenses.MAX_WORDINGS = licenses.MAX_WORDINGS, 50
    try:
        with pytest.raises(ValueError):
            licenses.read_wordings(spark, str(tmp_path / "notices"))
    finally:
        licenses.MAX_WORDINGS = limit


def test_a_block_of_a_megabyte_takes_linear_time():
    rng = random.Random(2)
    text = "\n".join(" ".join(["license", *sentences(rng, 12, vocabulary=60)]) for _ in range(16_000))
    assert len(text) > 1_000_000 and len(licenses.blocks(text)) == 1
    all_of, alone = licenses.templates(), licenses.zstandard.ZstdCompressor(licenses.LEVEL)
    began = time.process_time()
    assert licenses.scan(text, all_of, alone) == [] and time.process_time() - began < 20


def test_licences_on_odd_rows(spark):
    rows = ODD + [(1, "x\nReleased under the MIT License.\ny"), (1, "x\nReleased under the MIT License.\ny"),
                  (2, "your license to speak without warranty of anything")]
    out = licenses.op8_licenses(docs(spark, rows)).collect()
    assert [(r["doc_id"], r["license_id"], r["n_missing"]) for r in out] == [(1, "MIT", 0)] * 2
    assert licenses.op8_licenses(docs(spark, [])).count() == 0
