"""Chat formatting, URL filters, and the pipeline."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import chat, langid, stages, urls
from strata.llm.queries import QUERIES
from strata.llm.tables import held_out
from tests.conftest import SF_SMALL
from tests.llm import brute


# -- 6: chat -------------------------------------------------------------
def rendered(rows):
    turns = defaultdict(set)
    for c, t, r, x in rows:
        turns[c].add((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    kept = {}
    for c in sorted(own, key=lambda c: (c is not None, c or 0)):
        longer = any(len(o) > len(own[c]) and o[:len(own[c])] == own[c] for o in own.values())
        if not longer and own[c] not in kept.values():
            kept[c] = own[c]
    return {c: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in v) for c, v in kept.items()}


def test_chat_keeps_maximal_conversations(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "bye")]
    rows = [(c, i, *t) for c, n in ((1, 1), (2, 3), (3, 2), (4, 3)) for i, t in enumerate(talk[:n])]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "other"), (6, None, None, None), (6, 1, "user", None),
             (None, 0, "user", "lost"), (2, 0, "user", "hi"), (7, 3, "user", "same"), (7, 3, "user", "same turn")]
    rows += [(8, i, "user", f"turn {i}") for i in range(70)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(1))
    got = defaultdict(dict)
    for r in chat.render(df.repartition(5), turns_per_part=16).collect():
        got[r.conv_id][r.part] = r.rendered
    assert {c: "".join(p[k] for k in sorted(p)) for c, p in got.items()} == rendered(rows)
    assert len(got[8]) == 5
    assert chat.render(df.limit(0)).count() == 0


def test_chat_tells_a_missing_id_from_an_empty_one(spark):
    rows = [(None, 0, "user", "a"), ("", 0, "user", "b"), ("x", 0, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {(r.conv_id, r.n_turns, r.rendered) for r in chat.render(df).collect()}
    assert got == {(c, 1, f"<|im_start|>user\n{x}<|im_end|>\n") for c, _, _, x in rows}


# -- 10: URL filters -----------------------------------------------------
def judged(pages, iterations=300, damping=0.85, threshold=0.75):
    def host(u):
        m = re.match(r"(?s).*?://([^/?#]*)", u or "")
        return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""

    def path(u):
        m = re.match(r"(?s).*?://[^/?#]*([^?#]*)", u or "")
        return m[1] if m else ""

    def rule(h, p):
        fit = [(len(a + b), a + b, v) for a, b, v in urls.RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        return max(fit)[1:] if fit else (None, None)
    count = defaultdict(lambda: [0, 0, 0])
    edges = defaultdict(float)
    for _, u, html in pages:
        h = host(u)
        if h:
            v = rule(h, path(u))[1]
            count[h][0] += 1
            count[h][1] += v == "allow"
            count[h][2] += v == "block"
        for link in re.findall(urls.HREF, html or ""):
            to = host("x:" + link if link.startswith("//") else link)
            if h and to and to != h:
                edges[h, to] += 1

    def flow(edges, seed):
        total = defaultdict(float)
        for (a, _), w in edges.items():
            total[a] += w
        rank = dict(seed)
        for _ in range(iterations):
            new = defaultdict(float, {n: s * (1 - damping) for n, s in seed.items()})
            for (a, b), w in edges.items():
                if a in rank:
                    new[b] += rank[a] * w / total[a] * damping
            rank = dict(new)
        return defaultdict(float, rank)
    trust = flow(edges, {h: a / n for h, (n, a, _) in count.items() if a})
    fear = flow({(b, a): w for (a, b), w in edges.items()}, {h: b / n for h, (n, _, b) in count.items() if b})
    out = {}
    for i, u, _ in pages:
        h, p = host(u), path(u)
        r, v = rule(h, p)
        out[i] = (h, p, r, v or ("block" if fear[h] > threshold * (trust[h] + fear[h]) else "allow"))
    return out


def test_url_rules_and_propagation(spark):
    link = lambda *to: "".join(f'<a href="{t}">x</a>' for t in to)
    pages = [(1, "https://News.Example.ORG/a?b#c", link("https://friend.net/x")), (2, "http://example.org/es/", None),
             (3, "http://sub.example.org/en/12", ""), (4, "http://a.com/de/1", link("http://a.com/fr/2")),
             (5, "http://a.com/fr/2", ""), (6, "http://a.com", ""), (7, None, ""), (8, "no scheme", ""),
             (9, "http://spam.net/x", link("http://bad.com/de/1", "http://bad.com/de/2", "http://friend.net/")),
             (10, "http://bad.com/de/1", ""), (11, "http://bad.com/other", ""), (12, "http://friend.net/y", ""),
             (13, "x://h?q=/es/", ""), (14, "http://example.org:80/es/", ""), (15, "http://o.org?x", ""),
             (16, "http://far.net/", link("http://spam.net/")), (17, "http://example.org/en/1#x", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("node", F.lit("x"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert got == judged(pages)
    assert {got[i][3] for i in (9, 11, 16)} == {"block"} and got[12][3] == "allow"
    assert urls.judge(df.limit(0)).count() == 0
    assert urls.judge(df.unionAll(df)).count() == 2 * len(pages)


def test_distrust_reaches_the_end_of_a_chain(spark):
    """A chain of hosts that ends at a blocked page, longer than any number of rounds between two looks."""
    n = 23
    pages = [(i, f"http://h{i}.net/", f'<a href="{"" if i % 2 else "http:"}//h{i + 1}.net/">x</a>') for i in range(n)]
    pages += [(n, f"http://h{n}.net/", "<a href='//bad.com/de/1'>"), (n + 1, "http://bad.com/de/1", ""),
              (n + 2, "http://h0.net.other/", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert got == judged(pages)
    assert all(got[i][3] == "block" for i in range(n + 2)) and got[n + 2][3] == "allow"


def test_op10_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op10_urls"](spark, SF_SMALL).collect()}
    assert got == judged(rows)


# -- pipeline ------------------------------------------------------------
def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    told = langid.identify(docs, langid.fit(docs.where(~held_out())))
    rows = sorted((r.doc_id, r.text) for r in told.where("not rejected").collect())
    rows = [(d, t) for (d, t), (_, _, first) in zip(rows, brute.groups(rows, 5, 8, 10), strict=True) if d == first]
    want = {}
    enc = brute.tiktoken_encoding()
    for d, t in rows:
        n, hit, _ = brute.contamination(t, items)
        if not (hit and 20 * hit >= n):
            ids = enc.encode_ordinary(brute.redacted(t))
            want[d] = (len(ids), brute.sha(" ".join(map(str, ids))), len(brute.redacted(t)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.n_chars) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == want and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_documents(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    text = "the the of and to in that it is was for on are with as by this be from or an at " * 3
    rows = [(1, text, "en", "s", len(text)), (1, text, "en", "s", len(text)), (2, None, None, None, None),
            (None, "token=abcdefgh1234 " + text, None, "s", 5), (3, "", "de", "s", 0), (4, "12 34", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"tok": F.lit(1), "key": F.lit("x"), "secrets_found": F.lit(0)})
    made = stage(spark, docs, SF_SMALL)
    n = made.count()
    if stage is not stages.byte_bpe:
        assert made.columns == docs.columns
    assert n <= len(rows)
    if stage is stages.secret_scan:
        assert n == len(rows) and made.where("text like '[SECRET]%'").first().n_chars == len("[SECRET] " + text)
    assert stage(spark, docs.limit(0), SF_SMALL).count() == 0


@pytest.mark.parametrize("name", [n for n, f in corpus_pipeline.STAGES if f is not stages.byte_bpe])
def test_stages_keep_columns_of_any_name(spark, name):
    """Columns named like the operators' own neither lose rows nor change."""
    text = "the the of and to in that it is was for on are with as by this be from or an at "
    clash = ["text_hash", "_key", "_once", "score", "rejected", "margin", "lang_pred", "_bad_id", "_bad_text",
             "secrets", "clean", "_own_text"]
    rows = [(i, text + f"one two three four five six number {i} " * 9, "en", "s", 5) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in clash})
    made = dict(corpus_pipeline.STAGES)[name](spark, docs, SF_SMALL)
    assert made.columns == docs.columns
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, docs.collect()))
