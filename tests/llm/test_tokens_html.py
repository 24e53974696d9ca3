"""Piece encoding against the sentencepiece library, the token store by exact reading, extraction by expected texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyward.llm import html_text as Ht
from tallyward.llm import sentencepiece_unigram as Su
from tallyward.llm import token_store as Ts
from tallyward.llm.perfect_hash import PerfectHash
from tallyward.session import fresh_path

TEXTS = [
    "Hello world, this is a test.", " two  spaces  ", "tab\tand\nline\n\nends", "né à ß ☃ 😀 \u2581 marker", "a", " ", "", None,
    "unbroken" * 500, "word " * 3000, "...,,, ??? (a.b) isn't 3.14", "\x00\x7f\u200b\ufeff",
]


@pytest.fixture(scope="module")
def model():
    return Su.default_model()


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def unigram_file(model):
    """The same pieces and scores as a unigram model of the library: a message of pieces, trainer and normalizer settings."""
    import sentencepiece
    import struct

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    field = lambda n, b: varint(n << 3 | 2) + varint(len(b)) + b
    out = b""
    for i in range(sp.get_piece_size()):
        kind = 2 if sp.is_unknown(i) else 3 if sp.is_control(i) else 6 if sp.is_byte(i) else 1
        piece = field(1, sp.id_to_piece(i).encode()) + varint(2 << 3 | 5) + struct.pack("<f", model.scores[i]) + varint(3 << 3) + varint(kind)
        out += field(1, piece)
    trainer = varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1)  # unigram, byte fallback
    normalizer = field(1, b"identity") + b"".join(varint(n << 3) + varint(v) for n, v in ((3, 1), (4, 0), (5, 1)))
    return sentencepiece.SentencePieceProcessor(model_proto=out + field(2, trainer) + field(3, normalizer))


def test_encoding_equals_the_library(model, spark, sf):
    sp = unigram_file(model)
    codec = Su.Codec(model)
    texts = [t for t in TEXTS if t and "\u2581" not in t and "\x00" not in t]
    texts += [r[0][:3000] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(40).collect()]
    for text, ids in zip(texts, codec.encode_many(texts), strict=True):
        want = sp.encode(text)
        assert ids == want, text[:80]


def test_round_trips_and_columns(model, spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "x", 1), (0, TEXTS[0], 1)], "doc_id long, text string, __text int")
    out = Su.round_trips(df, Su.share(spark, model)).collect()
    assert len(out) == len(TEXTS) + 2 and all(r["exact"] for r in out)
    codec = Su.Codec(model)
    for r in out:
        if r["doc_id"] is not None:
            assert r["ids"] == codec.encode(TEXTS[r["doc_id"]]) and r["n_ids"] == len(r["ids"])
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
    m = Su.share(spark, model)
    back = df.select("text", Su.decode(m, Su.encode(m, df["text"])).alias("b")).collect()
    assert all((r["text"] or "") == r["b"] for r in back)
    assert Su.round_trips(df.limit(0), m).count() == 0


def test_chunks_change_nothing(model):
    codec = Su.Codec(model)
    for t in TEXTS:
        if t:
            assert "".join(codec.chunks(" " + t)) == " " + t
            assert codec.encode(t) == list(codec.viterbi(" " + t))


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 5000, dtype=np.uint64))
    made = PerfectHash.build(keys)
    again, size = PerfectHash.load(made.dump() + b"tail")
    assert size == len(made.dump())
    assert sorted(made.find(keys)) == list(range(len(keys))) and (again.find(keys) == made.find(keys)).all()
    assert PerfectHash.build(np.zeros(0, dtype=np.uint64)).size == 0
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5], dtype=np.uint64))


def test_token_store_reads_back_what_the_library_gives(spark):
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        blob = f.read()
    texts = [*TEXTS, "It's THE <|endoftext|> end.'s \u03a3\u0391\u03a3", "x" * 20000]
    rows = [(i * 3, t, 1) for i, t in enumerate(texts)] + [(6, "a second row of id 6", 1), (None, "no id", 1), (-5, "below", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Start int")
    manifest = Ts.write_store(df, blob, fresh_path(spark, "store-test"), shards=4)
    got = sorted((tuple(r) for r in Ts.read_store(df, manifest, with_ids=True).collect()), key=lambda r: r[1])
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), ids))
        start += len(ids)
    assert got == want
    strangers = spark.createDataFrame([(1,), (10**12,), (-6,)], "doc_id long")
    assert Ts.read_store(strangers, manifest).count() == 0
    empty = Ts.write_store(df.limit(0), blob, fresh_path(spark, "store-empty"), shards=2)
    assert empty.count() == 0 and Ts.read_store(df, empty).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>Home</ul></nav><div class="cookie-notice">We use cookies</div><!-- c -->
%s<aside>Side</aside><div id="comments"><p>First!</p></div><form><p>Name<input></form><footer>&copy; us</footer></body></html>"""


def test_extraction_of_an_article(spark):
    body = "<article><h1>A &amp; B</h1><p><b>One\n two</b> &lt;x&gt;<br>three<p>Four</p>five<ul><li>six<li>seven</ul><div class='ad'>Buy</div></article>"
    texts = [PAGE % body, PAGE % "<div><p>Plain page</p></div>", None, "", "no markup &eacute;", "<p>unclosed <b>bold", "<p>" + "w " * 50000]
    rows = [(i, "http://h.example/1", t, 1) for i, t in enumerate(texts)] + [(9, None, PAGE % body, 1), (0, "http://h.example/1", texts[0], 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, Text int")
    out = Ht.extract(df)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    article = "A & B\nOne two <x> three\nFour\nfive\nsix\nseven"
    assert got[0] == got[9] == article
    assert got[1] == "Plain page" and got[2] == got[3] == "" and got[4] == "no markup é" and got[5] == "unclosed bold"
    assert got[6] == ("w " * 50000).strip() and out.count() == 9
    assert Ht.extract(df.limit(0)).count() == 0


def test_template_subtrees_go(spark):
    """Blocks that recur on a host's pages are deleted; the same block on another host stays."""
    page = lambda i: f"<body><div><p>Welcome to our site</p></div><div><p>Story {i} of the day</p></div></body>"
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(12)] + [(50, "http://b.example/", page(50))]
    got = {r["page_id"]: r["text"] for r in Ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i} of the day" for i in range(12))
    assert got[50] == "Welcome to our site\nStory 50 of the day"


def test_shared_passages_of_articles_stay(spark):
    page = lambda i: f"<article><p>Quoted by many</p><p>Story {i}</p></article>" if i % 2 else f"<article><p>Story {i}</p></article>"
    rows = [(i, "http://a.example/", page(i)) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in Ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Quoted by many\nStory 3" and got[4] == "Story 4"
