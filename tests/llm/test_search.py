"""Lexical search, spelling variants and url filter against plain restatements of their rules."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import lexical_search, spelling, url_filter, workload

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, item_id long, n long, key string, score string, word string"
# nulls, empty and termless texts, repeated rows and ids, letters beyond ASCII, a very long text, a text of one term
AWKWARD = [
    (0, None), (1, ""), (2, " .,;\n"), (3, "Alpha beta ALPHA gamma-delta"), (3, "Alpha beta ALPHA gamma-delta"), (3, "beta"),
    (None, "alpha beta épée"), (None, None), (4, "ÉPÉE épée Épée 123 9lives"), (5, "alpha " * 30_000 + "omega"), (6, "zeta"), (7, "beta alpha"),
]


def frame(spark, rows):
    """`rows` (doc_id, text) with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, 2, "k", "s", "w") for i, t in rows], DOCS)


def random_texts(seed, n, words):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(pool, weights, k=rng.randint(0, 60)))) for i in range(n)]


# --- lexical search


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_ranking(documents, items, k=10):
    terms = [(i, plain_terms(t)) for i, t in documents]
    n_docs, total = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = Counter(t for _, ts in terms for t in set(ts))
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(plain_terms(text))
    found = []
    for item, words in asked.items():
        scored = []
        for doc_id, ts in terms:
            tf, score = Counter(ts), 0
            for t in words:
                if tf[t]:
                    m = 100 - 90 + 90 * len(ts) * n_docs // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1):
            found.append((item, rank, doc_id, -score))
    return found


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def ranked(spark, documents, items, **options):
    asked = spark.createDataFrame([(i, t, 9, "x") for i, t in items], "item_id long, text string, doc_id long, score string")
    return lexical_search.rank_documents(frame(spark, documents), asked, **options).collect()


def test_lists_equal_a_full_scoring(spark):
    documents = random_texts(1, 700, 150)
    items = [(i, t) for i, t in random_texts(2, 25, 150)]
    assert in_order(ranked(spark, documents, items)) == in_order(plain_ranking(documents, items))


def test_blocks_of_items_and_more_terms_than_a_word_of_bits(spark):
    documents = random_texts(3, 300, 400)
    items = [(i, " ".join(f"w{j}" for j in range(i, 400, 1 + i % 4))) for i in range(8)]  # 98 to 400 terms
    assert in_order(ranked(spark, documents, items, block_terms=150, k=7)) == in_order(plain_ranking(documents, items, 7))


def test_awkward_texts_and_items(spark):
    items = [(0, "alpha"), (0, "EPEE épée"), (1, None), (2, ""), (None, "Beta zeta"), (3, "nowhere"), (4, "alpha beta gamma delta omega 9lives")]
    assert in_order(ranked(spark, AWKWARD, items)) == in_order(plain_ranking(AWKWARD, items))


def test_ties_go_to_the_smaller_id(spark):
    documents = [(i, "same text here") for i in range(400)] + [(1000 + i, f"other {i}") for i in range(900)]
    found = ranked(spark, documents, [(0, "same")])
    assert [(r["rank"], r["doc_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [(i + 1, i) for i in range(10)]


def test_groups_of_low_bound_are_not_scored(monkeypatch):
    seen = []
    scores = lexical_search.Segment.scores
    monkeypatch.setattr(lexical_search.Segment, "scores", lambda self, docs, wanted: seen.append(len(docs)) or scores(self, docs, wanted))
    # one rare term in 50 documents, one common term in all 5,000
    sizes = np.where(np.arange(5000) < 50, 2, 1)
    terms = np.concatenate([[0, 1] if s == 2 else [1] for s in sizes])
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    segment = lexical_search.Segment(sizes, offsets, terms, np.ones(len(terms), np.int64), np.array([5000, 10]), 5000, int(sizes.sum()))
    docs, found = segment.best(np.array([0, 1]), 10, 1)
    assert sum(seen) < 200 and set(docs[np.argsort(-found)[:10]]) <= set(range(50))


def test_empty_tables(spark):
    assert ranked(spark, [], [(0, "alpha")]) == []
    assert ranked(spark, AWKWARD, []) == []


# --- spelling variants


def plain_variants(documents):
    counts = Counter()
    for doc_id, text in documents:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def edits(w):  # words with a gap or a wildcard at one place
        return {w[:i] + "*" + w[i + 1 :] for i in range(len(w))} | {w[:i] + "*" + w[i:] for i in range(len(w) + 1)}

    holders = defaultdict(set)
    for w in words:
        for e in edits(w):
            holders[e].add(w)
    near = defaultdict(set)
    for group in holders.values():
        for a, b in itertools.permutations(group, 2):
            one = sum(x != y for x, y in zip(a, b)) == 1 if len(a) == len(b) else None
            if one is None:
                short, long = sorted((a, b), key=len)
                one = len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))
            if one:
                near[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return rows


def text_rows(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


def spelled(seed, n_roots=12, n_docs=60):
    """Texts of few roots at many frequencies, with edits of them and edits of those."""
    rng, letters = random.Random(seed), "abcdeéÀÿ×"
    words = Counter()
    for _ in range(n_roots):
        word, n = "".join(rng.choices(letters, k=rng.randint(5, 14))), 900
        while n >= 3:
            words[word] += n
            for _ in range(4):
                i, c = rng.randrange(len(word)), rng.choice(letters)
                words[rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])] += n // rng.randint(4, 7)
            i = rng.randrange(len(word))
            word, n = word[:i] + rng.choice(letters) + word[i:], n // 5
    tokens = list(words.elements())
    rng.shuffle(tokens)
    return [(i, " ".join(t.upper() if i % 7 == 0 and t.isascii() else t for t in tokens[i::n_docs])) for i in range(n_docs)]


@pytest.mark.parametrize("cell", [2048, 3])
def test_variants_equal_a_plain_search(spark, cell):
    documents = spelled(5)
    found = spelling.spelling_variants(frame(spark, documents), cell=cell).collect()
    expected = plain_variants(documents)
    assert text_rows(found) == text_rows(expected) and any(r[1] and r[1] != r[2] for r in expected)


def test_a_hot_key_is_split_into_tiles(spark):
    words = spark.createDataFrame([(f"prefix{a}{b}suffix", 5) for a, b in itertools.product("abcdefghij", repeat=2)], "word string, n long")
    dealt = spelling.dealt(words, cell=10)
    tiles = dealt.groupBy("key", "i", "j").count().agg(F.max("count")).first()[0]
    assert tiles <= 45  # two cells of about ten words each, of 100 words under one key
    near = spelling.near_words(words, cell=10).collect()
    assert {r["n_near"] for r in near} == {18} and len(near) == 100


def test_awkward_words(spark):
    long = "x" * 40_000
    documents = [(i, f"Abcdef abcdeg {long} {long}y abcdefg ab×def") for i in range(30)] + [(None, "abcdef abcdeh"), (None, None), (3, "")] + [(9, "abcdef " * 50)] * 2
    found = spelling.spelling_variants(frame(spark, documents)).collect()
    assert text_rows(found) == text_rows(plain_variants(documents))
    assert spelling.spelling_variants(frame(spark, [])).collect() == []


def test_tiles_over_small_blocks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 7)
    words = sorted({w for _, t in spelled(8) for w in t.lower().split()})
    rows = {c: np.zeros(len(words), np.int64) for c in ("i", "j", "cell")}
    found = set()
    for longer in range(4, 18):
        for third in range(3):
            rows |= {"longer": np.full(len(words), longer), "third": np.full(len(words), third)}
            x, y = spelling.near_pairs(rows, np.zeros(len(words), int), words)
            new = {(words[a], words[b]) for a, b in zip(x, y)}
            assert not new & found
            found |= new
    longest = lambda a, b: max(len(a), len(b))
    expected = set()
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and a != b:
            short, long = sorted((a, b), key=len)
            same = sum(x != y for x, y in zip(a, b)) == 1 if len(a) == len(b) else any(long[:i] + long[i + 1 :] == short for i in range(len(long)))
            if same and 4 <= longest(a, b) < 18:
                expected.add((a, b))
    assert found == expected


# --- url filter


def judged(spark, urls, outcomes=(), **options):
    pages = spark.createDataFrame([(i, u, "<html>", "h", 1) for i, u in urls], "page_id long, url string, html string, host string, n long")
    labels = spark.createDataFrame(list(outcomes), "page_id long, bad boolean")
    return {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, labels, **options).collect()}


def test_hosts_paths_and_rules(spark):
    found = judged(
        spark,
        [
            (0, "http://A.Example.NET/en/x?y#z"), (1, "https://example.net/de/"), (2, "x://net"), (3, "http://notnet/"), (4, "http://m.example.com/de/1#t"),
            (5, "http://example.com/De/"), (6, "ftp://b.org/fr/?q"), (7, "http://b.org/en/"), (8, None), (9, "no scheme/net/"), (10, "http://h?a=http://net/"),
            (11, "a\nb://x.net/c"), (12, ""), (None, "http://net/"), (13, "://myexample.net/en/"), (14, "http://u:p@example.net:80/en/"),
        ],
    )
    assert found == {
        (0, "a.example.net", "/en/x"): ("example.net/en/", "allow"),
        (1, "example.net", "/de/"): ("net/", "block"),
        (2, "net", ""): (None, "allow"),
        (3, "notnet", "/"): (None, "allow"),
        (4, "m.example.com", "/de/1"): ("example.com/de/", "block"),
        (5, "example.com", "/De/"): (None, "allow"),
        (6, "b.org", "/fr/"): ("org/fr/", "allow"),
        (7, "b.org", "/en/"): (None, "allow"),
        (8, "", ""): (None, "allow"),
        (9, "", ""): (None, "allow"),
        (10, "h", ""): (None, "allow"),
        (11, "x.net", "/c"): ("net/", "block"),
        (12, "", ""): (None, "allow"),
        (None, "net", "/"): ("net/", "block"),
        (13, "myexample.net", "/en/"): ("net/", "block"),
        (14, "u:p@example.net:80", "/en/"): (None, "allow"),
    }


def plain_reputation(outcomes):
    """host -> bound, from (host, n, bad); hosts are names of three labels."""
    def weight(level):
        seen = [(n, bad, mean) for n, bad, mean in level.values() if n]
        alone = sum(m * (1 - m) for _, _, m in seen)
        shared = sum(m * (1 - m) * (n - 1) for n, _, m in seen)
        rho = (sum(n * (b / n - m) ** 2 for n, b, m in seen) - alone) / shared if shared > 0 else 0.001
        return 1 / min(max(rho, 0.001), 0.5) - 1

    def summed(key):
        total = defaultdict(lambda: [0, 0])
        for host, n, bad in outcomes:
            total[key(host)][0] += n
            total[key(host)][1] += bad
        return total

    means = {"": (sum(b for _, _, b in outcomes) + 1) / (sum(n for _, n, _ in outcomes) + 2)}
    for depth in (1, 2, 3):
        level = {k: (n, b, means[".".join(k.split(".")[1:])]) for k, (n, b) in summed(lambda h: ".".join(h.split(".")[-depth:])).items()}
        prior = weight(level)
        means = {k: (b + prior * m) / (n + prior) for k, (n, b, m) in level.items()}
        bounds = {k: means[k] - 1.645 * math.sqrt(means[k] * (1 - means[k]) / (n + prior + 1)) for k, (n, b, m) in level.items()}
    return bounds


def test_reputation_equals_the_plain_formulas(spark):
    rng = random.Random(3)
    outcomes = []
    for suffix, domain, host in itertools.product(["com", "org", "de"], ["a", "b", "c"], ["www", "m", "shop", "new"]):
        n = 0 if host == "new" else rng.randint(1, 80)
        outcomes.append((f"{host}.{domain}.{suffix}", n, sum(rng.random() < (0.9 if domain == "a" else 0.1) for _ in range(n))))
    bounds = plain_reputation(outcomes)
    found = url_filter.host_reputation(spark.createDataFrame(outcomes, "host string, n long, bad long")).collect()
    assert len(found) == len(outcomes) and all(abs(r["bound"] - bounds[r["host"]]) < 1e-9 for r in found)


def test_bad_hosts_are_blocked_and_few_labels_are_not_enough(spark):
    urls, outcomes, page = [], [], 0
    for host, n, bad in [("good.a.com", 200, 5), ("bad.b.com", 200, 195), ("few.a.com", 2, 2), ("new.a.com", 0, 0), ("new.b.com", 0, 0), ("ok.c.org", 100, 3)]:
        for i in range(max(n, 1)):
            urls.append((page, f"http://{host}/{i}"))
            outcomes += [(page, i < bad)] if n else []
            page += 1
    found = {host: verdict for (_, host, _), (_, verdict) in judged(spark, urls, [*outcomes, (None, True), (0, None)]).items()}
    assert found == {"good.a.com": "allow", "bad.b.com": "block", "few.a.com": "allow", "new.a.com": "allow", "new.b.com": found["new.b.com"], "ok.c.org": "allow"}


@pytest.mark.parametrize(
    "host, suffix, domain",
    [("a.b.co.uk", "co.uk", "b.co.uk"), ("b.com", "com", "b.com"), ("com", "com", "com"), ("", "", ""), ("1.2.3.4:80", "", "1.2.3.4"), ("u@x.y.org.:8", "org", "y.org"), ("co.uk", "co.uk", "co.uk")],
)
def test_suffix_and_domain(spark, host, suffix, domain):
    named = spark.createDataFrame([(host,)], "host string").withColumn("suffix", url_filter.suffix_of(F.col("host")))
    assert named.select("suffix", url_filter.domain_of(F.col("host"), F.col("suffix")).alias("domain")).first() == (suffix, domain)


def test_no_pages(spark):
    assert judged(spark, []) == {}


# --- the registered queries


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_spelling", "op13_url_filter"])
def test_query_equals_its_sql(spark, name):
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    engine = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = engine.execute(workload.ORACLE[name])
    columns = [c[0] for c in expected.description]
    found = workload.QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert text_rows(found.select(*columns).collect()) == text_rows(expected.fetchall())
