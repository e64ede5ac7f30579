import random

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD, docs

from tunnelscan.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def as_unigram(proto: bytes) -> bytes:
    """The same file with the model type of its trainer part set to unigram."""
    out, k = b"", 0
    fields = {}
    for number, value in pieces._fields(proto):
        fields.setdefault(number, []).append(value)

    def varint(x):
        s = b""
        while True:
            s += bytes([x & 127 | (128 if x > 127 else 0)])
            x >>= 7
            if not x:
                return s

    for number, values in fields.items():
        for v in values:
            if number == 2:
                v = v + varint(3 << 3) + varint(1)   # the last value of a field counts
            out += varint(number << 3 | 2) + varint(len(v)) + v
    assert k == 0
    return out


def texts():
    rng = random.Random(3)
    proto = open(PATH, "rb").read()
    vocabulary = pieces.Vocabulary(proto).pieces
    mixed = "".join(rng.choice(vocabulary[260:6000]) for _ in range(3000)).replace("▁", " ")
    spaced = " ".join(rng.choice(vocabulary[300:]).replace("▁", " ") for _ in range(3000))
    return ["", " ", "  two  spaces ", "\n\na\n", "tab\ta", "naïve 日本語 😀 é", "a" * 200, "hahahahaha aaaa ======== ......",
            "a\x00b", mixed, spaced, "Hello world, hello World."]


def test_bpe_ids_equal_the_library_and_decode_back():
    proto = open(PATH, "rb").read()
    v = pieces.Vocabulary(proto)
    assert v.bpe
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    rows = texts()
    ids, offs = pieces.encode_slice(pa.array(rows, pa.large_string()), v, pieces.Encoder(v))
    got = [ids[a:b].tolist() for a, b in zip(offs, offs[1:])]
    assert got == library.encode(rows)
    assert pieces.Decoder(v).decode(ids, offs) == rows


def best_score(word, v):
    """The best sum over every segmentation, by brute force."""
    if not word:
        return 0.0
    return max((v.score[word[:n]] if word[:n] in v.score else v.unknown_score) + best_score(word[n:], v)
               for n in range(1, len(word) + 1) if n == 1 or word[:n] in v.score)


def test_unigram_viterbi_has_the_best_score_of_all_segmentations():
    proto = as_unigram(open(PATH, "rb").read())
    v = pieces.Vocabulary(proto)
    assert not v.bpe
    words = ["▁Hello", "▁the", "▁quick", "▁" + "a" * 9, "hahaha", "▁national", "▁naïve", "日本", "\n"]
    got = pieces.Encoder(v).encode(sorted(words))
    for w, ids in zip(sorted(words), got):
        known = [v.pieces[i] for i in ids if v.kinds[i] == 1]
        unknown = sum(c not in v.id_of for c in w)
        assert sum(v.score[x] for x in known) + unknown * v.unknown_score == pytest.approx(best_score(w, v))
    # The library's unigram search reaches no better sum.
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    for text in ("Hello world", "the quick brown fox", "a" * 40, "internationalisation of words"):
        ids, _ = pieces.encode_slice(pa.array([text], pa.large_string()), v, pieces.Encoder(v))
        total = lambda x: sum(v.score[v.pieces[i]] for i in x)
        assert total(ids.tolist()) >= total(library.encode(text))


def test_shared_prefixes_do_not_change_the_ids():
    v = pieces.Vocabulary(open(PATH, "rb").read())
    words = sorted({f"▁{a}{b}" for a in ("inter", "intern", "in", "i") for b in ("", "nation", "national", "ed", "s")})
    together = pieces.Encoder(v).encode(words)
    assert together == [pieces.Encoder(v).encode([w])[0] for w in words]


def test_encode_and_decode_on_odd_rows(spark):
    rows = ODD + [(1, "Hello world"), (1, "Hello world")]
    out = pieces.encode(docs(spark, rows), PATH)
    got = {(r["doc_id"], r["decoded"]): r for r in out.collect()}
    assert out.count() == len(rows)
    assert all(r["round_trip"] for r in got.values())
    assert got[(900, "")]["ids"] == [] and got[(901, "")]["ids"] == []
    back = {(r["doc_id"], r["text"]) for r in pieces.decode(out, PATH).collect()}
    assert back == {(i, t or "") for i, t in rows}
    lists = spark.createDataFrame([(1, None), (2, [None, 263]), (3, [])], "doc_id long, ids array<int>")
    assert [r["text"] is None for r in pieces.decode(lists, PATH).orderBy("doc_id").collect()] == [True, False, False]


def test_empty_table(spark):
    assert pieces.op1_sentencepiece(docs(spark, []), PATH).count() == 0
