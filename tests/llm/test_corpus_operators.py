"""WARC archives, phrase collocations and spelling variants."""

import base64
import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import collocations, spelling, warc
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL, SF_ORACLE
from tests.llm import brute
from tests.oracle_harness import compare

INNER = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = "page_id long, url string, html string"


# -- 12: WARC --------------------------------------------------------------
def odd_pages():
    """Payloads that hold whole records, the magic, parts of it, or nothing."""
    made = [(i, f"http://h{i}/\r\n" if i % 3 else None,
             [None, "", "same", INNER * (1 + i % 2), f"x{i}" * (1 + i * 7 % 200) + "WARC/1." + warc.MAGIC * (i % 3),
              "é" * i, "\r\n\r\n"][i * 5 % 7]) for i in range(120)]
    return made + [(5, "u", "same"), (119, "h", "same"), (119, "h", "same"), (None, "n", None)]


def archived(pages, min_bytes=0):
    """Rows that reading gives, by brute force."""
    same = defaultdict(list)
    for i, _, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        same[(digest, len(raw), None if len(raw) >= min_bytes else len(same))].append(i)
    out = []
    for (digest, n, _), ids in same.items():
        ids.sort(key=lambda i: -1 if i is None else i)
        out.append((ids[-1], n, digest, "response", None, True))
        out += [(i, n, digest, "revisit", ids[-1], True) for i in ids[:-1]]
    return sorted(out, key=str)


def read_back(spark, folder):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.digest_ok)
                   for r in warc.read(spark, folder).collect()), key=str)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_round_trip_over_small_ranges(spark, compression):
    """Every file is read in ranges of 3000 bytes, so that records, payloads
    and magics straddle them."""
    df = spark.createDataFrame(odd_pages(), PAGES).withColumns({"digest": F.lit("x"), "n": F.lit(1)}).repartition(2)
    folder = warc.write(df, compression=compression, records_per_file=80)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert read_back(spark, folder) == archived(odd_pages())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_warc_small_payloads_and_empty_tables(spark):
    df = spark.createDataFrame(odd_pages(), PAGES)
    assert read_back(spark, warc.write(df, min_bytes=5)) == archived(odd_pages(), 5)
    assert read_back(spark, warc.write(df.limit(0))) == []


def test_warc_keeps_urls_and_tells_damage(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/é", "x" * 50), (2, "http://b/", "y" * 50)], PAGES).coalesce(1)
    folder = warc.write(df, str(tmp_path / "whole"), compression="none")
    assert {r.page_id: r.url for r in warc.read(spark, folder).collect()} == {1: "http://a/é", 2: "http://b/"}
    (file,) = [f for f in (tmp_path / "whole").glob("*.txt") if f.stat().st_size]
    raw = file.read_bytes()
    for name, text in (("cut", raw[:-9]), ("shifted", b"x" + raw), ("length", raw.replace(b"Content-Length: 12", b"Content-Length: 13"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.txt").write_bytes(text)
        with pytest.raises(ValueError, match="no unbroken chain"):
            warc.read(spark, str(tmp_path / name))
    (tmp_path / "changed").mkdir()
    (tmp_path / "changed" / "a.txt").write_bytes(raw.replace(b"xxxxx", b"zzzzz", 1))
    assert {r.page_id: r.digest_ok for r in warc.read(spark, str(tmp_path / "changed")).collect()} == {1: False, 2: True}


def test_op12_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_warc"](spark, SF_SMALL).collect()), key=str)
    assert got == sorted((r[:5] for r in archived(pages)), key=str)
    assert compare(spark, "op12_warc", SF_ORACLE)["match"]


# -- 13: collocations ------------------------------------------------------
def mined(df, **settings):
    made = collocations.collocations(df, **settings)
    return sorted(tuple(r) for r in made.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def odd_texts(seed=3):
    """Random pieces over few words, so that phrases repeat and overlap; words
    of control characters and accents, a long text, repeated rows, NULLs."""
    rng = random.Random(seed)
    words = ["a", "the", "The", "é", "É", "of", "new", "york", "\x01", "\x1f", "x" * 90, "times", "\u3042\u3044"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!"]
    rows = []
    for i in range(60):
        n = 30 if i else 4000
        text = "".join(w + rng.choice(gaps) for w in rng.choices(words, weights=range(len(words), 0, -1), k=n))
        rows.append((text + "new york times new york times", [None, "und", "en", "de"][i % 4]))
    return [*rows, *rows[:9], (None, "en"), ("", "en"), (" .,", None), ("alone", "fr")]


@pytest.mark.parametrize("settings", [{}, {"max_words": 2, "min_count": 2}, {"max_words": 4, "min_count": 3, "top": 25},
                                      {"share_percent": 80, "min_count": 5}])
def test_collocations_against_brute_force(spark, settings):
    rows = odd_texts()
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7).withColumns(
        {"word": F.lit(1), "key": F.lit("x"), "n": F.lit(2)})
    names = {"max_words": "max_words", "min_count": "least", "share_percent": "share", "top": "top"}
    assert mined(df, **settings) == brute.collocations(rows, **{names[k]: v for k, v in settings.items()})
    assert mined(df.limit(0), **settings) == []


def test_collocations_over_ranges_and_slices(spark, monkeypatch):
    """More ranges than words, texts cut into slices, and a bitmap so small that it passes everything."""
    rows = odd_texts(5)
    monkeypatch.setattr(collocations, "slices", lambda part: (part.slice(i, 1) for i in range(len(part))))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert mined(spark.createDataFrame(rows, "text string, lang string")) == brute.collocations(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_collocation_scores_beyond_64_bits(spark):
    """10^6 a^2 and l r of these counts pass 64 bits."""
    a, left, right = 3_000_000_007, 4_000_000_009, 5_000_000_021
    rows = spark.createDataFrame([([1], left, "en", "x"), ([2], right, "en", "y"), ([1, 2], a, None, None)],
                                 "key array<long>, f long, lang string, word string")
    found = collocations.ranked(collocations.with_parts(rows, 2), 50, None).first()
    assert found.score == 10 ** 6 * a * a // (left * right) and (found.l, found.r) == (left, right)


def test_op13_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_collocations"](spark, SF_SMALL).collect()) == brute.collocations(rows)
    assert compare(spark, "op13_collocations", SF_ORACLE)["match"]


# -- 11: spelling variants -------------------------------------------------
def grouped(df, **settings):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, **settings).collect()}


@pytest.mark.parametrize("settings", [{}, {"qmax": 4, "extend_above": 0.01}, {"qmin": 3, "qmax": 5, "extend_above": 0.001},
                                      {"qmin": 2, "qmax": 2}, {"max_grams": 5}])
def test_variants_of_random_words(spark, monkeypatch, settings):
    """Words over few letters, so that most have near words; short ones of
    which an edit can affect every gram; lists split over tasks."""
    monkeypatch.setattr(spelling, "LIST_SIZE", 20)
    rng = random.Random(7)
    made = {"".join(rng.choices("abé", k=rng.choice([1, 2, 3, 5, 6, 7, 7, 8, 9]))) for _ in range(500)}
    made |= {"z" * 300, "z" * 301, "z" * 150 + "y" + "z" * 150, "ÿ", "ÿa"}
    count = {w: rng.choice([2, 3, 20, 25, 300, 4000, 50_000]) for w in sorted(made)}
    df = spark.createDataFrame([(w, n, 1) for w, n in count.items()] + [("", 5, 1), (None, 5, 1)],
                               "word string, n long, size int")
    assert grouped(df.unionAll(df).repartition(3), **settings) == brute.variants(count)
    assert grouped(df.limit(0), **settings) == {}


def test_affected_grams_hold_for_every_edit():
    """No edit of a word leaves fewer of its grams than the bound says."""
    rng = random.Random(11)
    longer = {"".join(rng.choices("ab", k=k)) for k in (3, 3, 3, 4, 4, 5) for _ in range(3)}
    index = spelling.Grams(2, 5, longer, {})
    for _ in range(300):
        word = "".join(rng.choices("abc", k=rng.randrange(2, 11)))
        mine = index.decompose(word)
        kept = len(mine) - index.affected(word, mine)
        edits = [(i, word[:i] + x + word[i + cut:], len(x) - cut) for i in range(len(word) + 1) for x in ("", "a", "b", "c", "d")
                 for cut in (0, 1) if i + cut <= len(word) and len(x) + cut]
        for i, other, shift in edits:
            theirs = set(index.decompose(other))
            assert sum((p, g) in theirs if p + len(g) <= i else (p + shift, g) in theirs for p, g in mine) >= kept


def test_words_lose_a_letter_by_their_document(spark):
    rows = [(d, t) for d in (*range(60), None) for t in ("Wonderful wonderfully ÉTUDIANT étudiant short", None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "doc": F.lit("x")})
    got = {r.word: r.n for r in spelling.word_counts(df, drop_every=31, min_count=1).collect()}
    assert got == brute.spelling_words(rows, least=1)
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == {
        "wonderful": 61, "wonderfully": 61, "Étudiant": 61, "étudiant": 61}


def test_op11_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op11_spelling"](spark, SF_ORACLE).collect()}
    assert got == brute.variants(brute.spelling_words(rows))
    assert compare(spark, "op11_spelling", SF_ORACLE)["match"]
