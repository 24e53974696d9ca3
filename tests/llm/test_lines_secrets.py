"""Line dedup, secret scans and decontamination against plain versions, with odd inputs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyward.llm import decontaminate as De
from tallyward.llm import line_dedup as Ld
from tallyward.llm import secrets as Se

DOCS = "doc_id long, text string, lang string, H1 int"
LONG = "This line is long enough to count"


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, None, 1) for i, t in texts], schema)


def plain_lines(texts, min_docs=3, min_chars=20):
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, t in texts:
        for s in (t or "").split("\n"):
            holders.setdefault(key(s), set()).add(i)
    low = lambda x: -1 if x is None else x
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = [
            s for s in lines
            if len(key(s)) < min_chars or len(holders[key(s)]) < min_docs or max(holders[key(s)], key=low) == i
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_line_dedup_equals_plain(spark):
    rng = random.Random(3)
    pool = [LONG, f"  {LONG.upper()}\t", "short", "", "Été long enough to be counted", "ÉTÉ long enough to be counted", f"{LONG}é"]
    texts = [(i, "\n".join(rng.choice([*pool, f"own line number {i} {j} of text"]) for j in range(rng.randrange(8)))) for i in range(60)]
    texts += [(7, texts[7][1]), (None, LONG), (61, None), (62, ""), (63, LONG * 3000), (64, f"{LONG}\n{LONG}")]
    got = Ld.drop_repeated_lines(frame(spark, texts))
    assert got.columns == ["doc_id", "text", "lang", "H1", "kept_text", "n_lines", "n_dropped"]
    rows = sorted(((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr)
    assert rows == plain_lines(texts)


def test_line_dedup_of_an_empty_table(spark):
    assert Ld.drop_repeated_lines(frame(spark, [])).count() == 0


def plain_secrets(text):
    found = []
    for rank, rule in enumerate(Se.RULES):
        for m in re.finditer(rule.regex, text or ""):
            if len(m.group(rule.value_group)) >= rule.value_min:
                found.append((m.start(), rank, m.end()))
    return ",".join(f"{Se.RULES[r].kind}:{s}:{e}" for s, r, e in sorted(found))


def test_secrets_equal_plain(spark):
    hexes = "0123456789abcdef" * 3
    texts = [
        "password=token:abcdef12 Token: secret=abcdef API_KEY = 'abcdefgh' apikey:x",
        "AKIA" + "B" * 15 + " AKIA" + "C" * 16 + "AKIAAKIA" + "D" * 20,
        f"é ☃ {hexes} {hexes[:23]} 😀 {hexes}g",
        "ghp_" + "a" * 36 + " xoxb-1234567890-abc sk_live_" + "z" * 20 + " AIza" + "Q" * 35,
        "eyJabcdefgh.eyJabcdefgh.abcdefgh -----BEGIN RSA PRIVATE KEY-----",
        "paſſword=abcdefgh toKen=abcdefgh",  # long s and Kelvin sign are other letters
        "", None, "nothing " * 5000 + f"passwd:{hexes}", "password=a" * 300,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1]), (3, "secret = other1")]
    got = Se.scan(frame(spark, rows)).select("doc_id", "text", Se.spans_text(F.col("found")).alias("s"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, t, plain_secrets(t)) for i, t in rows), key=repr)
    assert Se.scan(frame(spark, [])).count() == 0


def test_trigram_queries_are_necessary():
    samples = {
        "assign": ["API_Key: abcdef", "apikey=abcdef", "Passwd='abcdef"], "access": ["AKIAX"], "slack": ["xoxp-aaaaaaaaaa"],
        "private_key": ["-----BEGIN PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----"],
    }
    for rule in Se.RULES:
        for s in samples.get(rule.kind, []):
            assert re.search(rule.regex, s)
            assert any(all(t in s.lower() for t in clause) for clause in rule.clauses())
    assert [r.kind for r in Se.RULES if not r.clauses()] == ["hex"]


BENCH = "item_id long, text string"
ITEM = "A train leaves Boston with 12 cars and each car holds 40 people. How many people can the 12 cars of the train hold in total?"


def test_decontamination_catches_other_parameters(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, "one two three four five")], BENCH)
    again = ITEM.replace("12", "15").replace("40", "36").replace("Boston", "Denver")
    twisted = ITEM.replace("12", "15", 1).replace("40", "36")  # 12 stands for two values: another question
    clean = "Some words that have nothing to do with it at all, only plain prose about rivers and hills in spring."
    texts = [
        (10, f"Intro words here.\n{ITEM}\nMore."), (11, again), (12, twisted), (13, clean), (14, None), (15, ""),
        (16, clean * 400 + again), (10, f"Intro words here.\n{ITEM}\nMore."), (None, ITEM),
    ]
    got = {(r["doc_id"], r["item_id"]): r for r in De.contaminated(frame(spark, texts), bench).collect()}
    assert {k[0] for k in got} >= {10, 11, 16, None} and {k[0] for k in got}.isdisjoint({13, 14, 15})
    assert (12, 1) not in got
    assert got[(10, 1)]["n_changed"] == 0 and got[(11, 1)]["n_changed"] == 3
    assert got[(10, 1)]["n_matched"] == got[(10, 1)]["n_windows"]
    left = De.drop_contaminated(frame(spark, texts), bench)
    assert {r["doc_id"] for r in left.collect()} == {12, 13, 14, 15} and left.columns == ["doc_id", "text", "lang", "H1"]


def test_one_conflict_does_not_clear_a_copy(spark):
    """A repeated value edited once, different values that become equal, and 2 written as two."""
    item = (
        "A farmer keeps 5 hens in the yard behind the old barn and feeds them corn every single morning before work. "
        "Each of the 5 hens lays 3 eggs on most days of the summer, so how many eggs are there?"
    )
    edited = item.replace("the 5 hens", "the 7 hens")
    equal = item.replace("5", "4").replace("3", "4")
    spelled = item.replace("keeps 5", "keeps 2").replace("the 5", "the two")
    docs = frame(spark, [(1, edited), (2, equal), (3, spelled)])
    got = {r["doc_id"]: r for r in De.contaminated(docs, spark.createDataFrame([(1, item)], BENCH)).collect()}
    assert set(got) == {1, 2, 3} and got[1]["n_changed"] == 1
    assert got[2]["n_matched"] == got[2]["n_windows"] and got[3]["n_matched"] == got[3]["n_windows"]
    assert got[1]["n_windows"] / 2 <= got[1]["n_matched"] < got[1]["n_windows"]


def test_short_items_are_found(spark):
    items = [
        (1, "日本の首都はどこですか"), (2, "What is 12 + 34 - 56?"), (3, "What is the capital city of France?"),
        (4, "Anna has 5 apples and eats 2 daily."), (5, "Define osmosis"), (6, "???"),
    ]
    texts = [
        (1, "質問は日本の首都はどこですかと聞いた"), (2, "Please say: what is 12 + 34 - 56?"),
        (3, "Question: What is the capital city of France?"), (4, "Bob has 7 apples and eats 3 daily."),
        (5, "Your task: define osmosis."), (6, "What is 13 + 34 - 56? That is the capital city of Spain. 日本の首都は"),
    ]
    got = {(r["doc_id"], r["item_id"]): r for r in De.contaminated(frame(spark, texts), spark.createDataFrame(items, BENCH)).collect()}
    assert set(got) == {(i, i) for i in range(1, 6)}
    assert got[(3, 3)]["n_changed"] == 0 and got[(4, 4)]["n_changed"] == 3


def test_a_long_passage_is_found_whatever_its_share(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)]
    texts = [(1, "Some prose before it. " + " ".join(words[100:340])), (2, "Some prose before it. " + " ".join(words[100:119]))]
    bench = spark.createDataFrame([(1, " ".join(words))], BENCH)
    got = [tuple(r) for r in De.contaminated(frame(spark, texts), bench).collect()]
    assert got == [(1, 1, 233, 593, 0)]


@pytest.mark.parametrize("docs, bench", [([], [(1, ITEM)]), ([(1, ITEM)], [])])
def test_decontamination_of_empty_tables(spark, docs, bench):
    assert De.contaminated(frame(spark, docs), spark.createDataFrame(bench, BENCH)).count() == 0


def test_kept_text_digest(spark):
    row = Ld.drop_repeated_lines(frame(spark, [(1, "a\nb")])).select(F.sha2("kept_text", 256)).first()
    assert row[0] == hashlib.sha256(b"a\nb").hexdigest()
