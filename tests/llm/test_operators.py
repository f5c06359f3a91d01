"""The dealt operators against brute force, on tables with every odd case."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from simdex.llm import (ann, bpe, html_text, jaccard_join, langid, mixing, pii, quality, suffix_dedup, suffix_sort,
                        token_counts)
from simdex.llm.common import utf8


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- 1: suffix arrays --------------------------------------------------------


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 70))] + [0]
        order = suffix_sort.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        text = np.array(s, np.uint8)
        room = len(s) - 1 - np.arange(len(s))
        phi, length = suffix_sort.common_prefixes(text, order, room)
        for i, p in enumerate(phi.tolist()):
            if p >= 0:
                n = 0
                while i + n < len(s) and p + n < len(s) and s[i + n] == s[p + n]:
                    n += 1
                assert length[i] == min(n, room[i])


def removed(texts):
    raw = [(t or "").encode() for t in texts]
    n = Counter(b[i:i + 200] for b in raw for i in range(len(b) - 199))
    for b in raw:
        cover = [False] * len(b)
        for i in range(len(b) - 199):
            if n[b[i:i + 200]] > 1:
                cover[i:i + 200] = [True] * 200
        spans = sum(c and (not i or not cover[i - 1]) for i, c in enumerate(cover))
        kept = bytes(x for x, c in zip(b, cover) if not c)
        yield len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("contexts", [4096, 0, 1])
def test_suffix_dedup(odd_docs, odd_rows, no_docs, contexts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)
    want = sorted(((r[0], *x) for r, x in zip(odd_rows, removed([r[1] for r in odd_rows]))), key=str)
    assert rows_of(suffix_dedup.suffix_dedup(odd_docs)) == want
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0


def test_suffix_dedup_slices(spark, monkeypatch):
    """A text longer than a slice, and passages that begin anywhere."""
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    rng = random.Random(1)
    base = "".join(rng.choice("abcdef ") for _ in range(4000))
    texts = [base, base[700:1100] + "x" + base[2000:2600], "y" * 900, base[:199], base[100:300]]
    got = {r.doc_id: tuple(r)[1:] for r in
           suffix_dedup.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == list(removed(texts))


@pytest.mark.parametrize("contexts", [4096, 5])
def test_suffix_dedup_large_anchor(spark, contexts, monkeypatch):
    """A passage of 150 bytes between other words each time, one of 190, and one that is long enough."""
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    license, notice, long = word(150), word(190), word(230)
    texts = [word(rng.randint(100, 300)) + rng.choice([license, notice, long]) + word(rng.randint(100, 300)) for _ in range(60)]
    texts += [texts[0], texts[1][:-50] + word(20), long + license, license * 3]
    got = {r.doc_id: tuple(r)[1:] for r in
           suffix_dedup.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == list(removed(texts))


# -- 2: nearest neighbours ---------------------------------------------------


def test_ann(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 12))
    x[100:400] = x[100]          # half the rows are one vector
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(x)]
    rows += [(1000, None, 1, 2), (1001, [0.0] * 12, 1, 2), (1002, [float("nan")] + [1.0] * 11, 1, 2),
             (1003, [1.0, None] + [1.0] * 10, 1, 2), (1004, [1.0] * 3, 1, 2), (1005, [], 1, 2), (None, [1.0] * 12, 1, 2),
             (0, x[0].tolist(), 1, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, node int, sim int")
    got = defaultdict(list)
    for r in sorted(ann.nearest(df, df.where("vec_id % 50 = 0")).collect()):
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 50))
    norm = np.sqrt((x * x).sum(axis=1))
    found = total = 0
    for q, hits in got.items():
        s = x @ x[q] / (norm * norm[q])
        s[q] = -9
        assert [h[0] for h in hits] == [1, 2, 3, 4, 5]
        assert all(abs(h[2] - s[h[1]]) < 1e-12 for h in hits)
        best = np.lexsort((np.arange(600), -s.round(12)))[:5].tolist()
        if 100 <= q < 400:       # its copies, the smallest ids first
            assert [h[1] for h in hits] == [i for i in range(100, 106) if i != q][:5]
        found += len(set(best) & {h[1] for h in hits})
        total += 5
    assert found / total >= 0.9


def test_ann_small(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], schema)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], schema)
    assert [(r.query_id, r.vec_id) for r in sorted(ann.nearest(two).collect())] == [(0, 1), (1, 0)]
    assert ann.nearest(spark.createDataFrame([(0, [1.0, 0.0])], schema)).count() == 0


# -- 3: HTML -----------------------------------------------------------------


def test_repeated_runs():
    rng = random.Random(1)
    for _ in range(40):
        streams = [[rng.randint(1, 3) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 6))]
        pages = defaultdict(set)
        for i, s in enumerate(streams):
            for j in range(len(s) - 3):
                pages[tuple(s[j:j + 4])].add(i)
        want = [[j for j in range(len(s) - 3) if len(pages[tuple(s[j:j + 4])]) > 1] for s in streams]
        assert [x.tolist() for x in html_text.repeated_runs([np.array(s, np.int64) for s in streams], 4, 2)] == want


def test_blocks():
    page = ("<!DOCTYPE html><title>T</title><style>p{}</style><script>var t='</p>';</script><nav><ul><li>Menu</li></ul></nav>"
            "<!-- <p>x</p> --><div class='ad-box'>Buy</div><main><header><h1>A &amp; B</h1></header><p>one<b> two</b>\n three"
            "<p>four<br>five<aside>side</aside> six</p><section id=comments><p>me too</p></section></main><form>f</form><footer>&copy;")
    kept = [t for z, t in html_text.blocks(page) if z == html_text.ARTICLE]
    assert kept == ["A & B", "one two three", "four five", "six"]
    assert html_text.blocks(None) == html_text.blocks("") == html_text.blocks("<p></p><script>x") == []


@pytest.mark.parametrize("page, want", [
    ('<article><p>one</p><a class="social">f</a><p>two</p><p>three</p></article>', ["one", "two", "three"]),
    ('<article><p>one <span class="ad">x <span>y</span> z</span> tail</p></article>', ["one tail"]),
    ('<article><p>one <b class="promo">x</p><p>two</p></article>', ["one", "two"]),
    ('<body class="has-sidebar"><article><p>one</p></article></body>', ["one"]),
    ('<div id="page" class="no-sidebar"><main><p>one</p></main></div>', ["one"]),
    ('<div class="page sidebar-right"><div class="sidebar">s</div><article><p>one</p></article><div class="sidebar">s</div></div>', ["one"]),
    ('<article class="post related-topics"><p>one</p></article>', ["one"]),
    ('<form id="all"><div><article><p>one</p><form>f</form><p>two</p></article></div></form>', ["one", "two"]),
    ('<aside><article><p>card</p></article></aside><article><p>one</p></article><div class="related"><article>card</article></div>', ["one"]),
    ('<article><p>one</p><section class="comments"><p>me too</p></section><img class="ad"><p>two</p></article>', ["one", "two"]),
    ('<nav><article>x</article></nav><main hidden>y</main><main>one</main>', ["one"])])
def test_marked_elements(page, want):
    assert [t for z, t in html_text.blocks(page) if z == html_text.ARTICLE] == want


def test_long_page():
    """A page of megabytes, and elements that nest deep or never end, take linear time."""
    for page in ("<article>" + "<p>one <b>two</b> three</p>" * 60_000, "<article>" + "<div>a" * 20_000, "<article><p>" + "x<span class=ad>y" * 300):
        t = time.time()
        assert html_text.blocks(page) and time.time() - t < 20


@pytest.mark.parametrize("shard", [5000, 2])
def test_extract(spark, shard, monkeypatch):
    monkeypatch.setattr(html_text, "SHARD_PAGES", shard)
    page = ("<div>Welcome to our wonderful site for all friends</div><div>Page {0} has a story {0} about thing number {0} only</div>"
            "<p>Read more on our partner pages every day</p>").format
    rows = [(i, f"http://h.org/{i}", page(i), "x") for i in range(6)]
    rows += [(9, None, page(9), "x"), (10, "http://h.org/10", None, "x"), (0, "http://h.org/0", page(0), "x"),
             (11, "http://h.org/11", "<article><p>Welcome to our wonderful site for all friends</article><p>x", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract(df).collect()}
    assert html_text.extract(df).count() == len(rows)
    for i in range(6):
        want = f"Page {i} has a story {i} about thing number {i} only"
        assert got[i, f"http://h.org/{i}"] == (want, len(want))
    assert got[9, None][0].count("\n") == 2 and got[10, "http://h.org/10"] == ("", 0)
    assert got[11, "http://h.org/11"][0] == "Welcome to our wonderful site for all friends"
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("shard", [5000, 1])
def test_pages_with_equal_chrome(spark, shard, monkeypatch):
    """Article pages with the same chrome are as many pages as they have urls; copies of a page without an article are one."""
    monkeypatch.setattr(html_text, "SHARD_PAGES", shard)
    menu = "Home News Sport Weather Travel Shop Contact"
    article = f"<nav>{menu}</nav><article><p>Story</article>"
    plain = f"<div>{menu}</div><p>A single story of this page alone stands here</p>"
    rows = [(i, f"http://{h}/{i if h != 'one.org' else 0}", article, ["Story"]) for h in ("a.org", "one.org") for i in range(3)]
    rows += [(9, "http://a.org/9", plain, ["A single story of this page alone stands here"])]
    rows += [(9, "http://one.org/9", plain, [menu, "A single story of this page alone stands here"])]
    rows += [(i, f"http://copies.org/{i}", plain, [menu, "A single story of this page alone stands here"]) for i in range(5)]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    got = sorted((r.page_id, r.url, r.text) for r in html_text.extract(df).collect())
    assert got == sorted((i, u, "\n".join(t)) for i, u, _, t in rows)


@pytest.mark.parametrize("hot", [4096, 3])
def test_sharded_runs(spark, hot, monkeypatch):
    """A host sorted in shards of its anchors has the runs of one sorted whole; the suffix array finds them in both."""
    rng = random.Random(4)
    menu = [rng.getrandbits(62) | 1 for _ in range(12)]
    rows = []
    for host in ("a.org", None, "b.org"):
        for i in range(14):
            own = [rng.choice(menu[:4]) for _ in range(rng.randint(0, 40))]
            rows.append((host, i, own[:9] + menu[rng.randint(0, 5):] + own[9:]))
    rows.append(("b.org", 99, menu[:3]))
    streams = spark.createDataFrame(rows, "host string, stream bigint, tokens array<bigint>")
    found = lambda: sorted(map(tuple, html_text.host_runs(streams).collect()), key=str)
    whole = found()
    assert len(whole) >= 42
    monkeypatch.setattr(html_text, "SHARD_PAGES", 2)
    monkeypatch.setattr(html_text, "SHARD_SEGMENTS", hot)
    monkeypatch.setattr(html_text, "SORT_TOKENS", 200)
    assert found() == whole
    monkeypatch.setattr(html_text, "repeated_runs", lambda streams, *_: [np.zeros(0, np.int64) for _ in streams])
    assert found() == []


def test_segments():
    """Each window is in one segment, and equal windows have equal anchors."""
    rng = random.Random(2)
    for length in html_text.ANCHORS:
        anchor_of = {}
        for n in (0, 5, 6, 7, 60, 300):
            t = np.array([rng.randint(1, 3) for _ in range(n)], np.int64)
            seen = []
            for a, start, end in zip(*html_text.segments(t, 6, length)):
                seen += range(start, end - 5)
                for j in range(start, end - 5):
                    assert anchor_of.setdefault(tuple(t[j:j + 6]), a) == a
            assert seen == list(range(max(0, n - 5)))


# -- 4: Jaccard join ---------------------------------------------------------


def shingle_set(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_join(rows):
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                root[find(i)] = find(j)
                if a != b:
                    links[a].add(b)
                    links[b].add(a)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    for i, r in enumerate(rows):
        group = ids[find(i)]
        yield (r[0], min((x for x in group if x is not None), default=None), len(links[sets[i]]), len(group),
               sum(s == sets[i] for s in sets) if sets[i] else 1)


@pytest.mark.parametrize("block", [512, 3])
def test_jaccard_join(odd_docs, odd_rows, no_docs, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    joined = jaccard_join.jaccard_join(odd_docs)
    assert rows_of(joined.drop("row", "class")) == sorted(brute_join(odd_rows), key=str)
    assert jaccard_join.jaccard_join(no_docs).count() == 0
    kept = jaccard_join.drop_near_copies(odd_docs, joined).collect()
    classes = Counter(r[1] for r in brute_join(odd_rows) if r[2] or r[3] > 1)
    assert len(kept) == len({(r[0], r[1], r[4]) for r in odd_rows}) - sum(
        len({(r[0], r[1]) for r, b in zip(odd_rows, brute_join(odd_rows)) if b[1] == c and (b[2] or b[3] > 1)}) - 1
        for c in classes)
    assert kept[0].__fields__ == odd_docs.columns


def test_jaccard_join_shared_ids(spark):
    """Null and repeated ids whose texts have near copies: each text is checked on its own words."""
    rng = random.Random(11)
    rows = []
    for g in range(6):
        words = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(80)]
        ids = [None, None, 7, 7, 7, 100 + g]
        for i, doc_id in enumerate(ids):
            near = list(words)
            if i:
                near[i] = f"other{i}"
            rows.append((doc_id, " ".join(near), "en", "a"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(3)
    joined = jaccard_join.jaccard_join(docs)
    want = list(brute_join(rows))
    assert all(w[2] for w in want)
    assert rows_of(joined.drop("row", "class")) == sorted(want, key=str)
    assert jaccard_join.drop_near_copies(docs, joined).count() == 6


def test_bayesian_pruning():
    assert jaccard_join.least_matches(36, 0.8, 1e-7) > 5
    # P(J >= t | m of n) by integration of the Beta posterior
    for n, m in ((36, 20), (72, 50)):
        t = np.linspace(0, 1, 200_001)
        d = t ** m * (1 - t) ** (n - m)
        p = d[t >= 0.8].sum() / d.sum()
        assert (jaccard_join.least_matches(n, 0.8, p * 1.05) > m) and jaccard_join.least_matches(n, 0.8, p * 0.95) <= m


# -- 5: mixing ---------------------------------------------------------------


def word_count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        got = {s: 3 * sizes[s] if s in full else rest * weight[s] / free for s in names}
        more = {s for s in names if s not in full and got[s] > 3 * sizes[s]}
        if not more:
            return got
        full |= more


def test_mix(odd_docs, odd_rows, no_docs):
    mixed = mixing.mix(odd_docs)
    got = mixed.collect()
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += word_count(r[1])
    want = brute_targets(dict(sizes))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], word_count(r[1])) for r in odd_rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert rows_of(mixing.mix(odd_docs.repartition(2))) == rows_of(mixed)
    assert mixing.mix(no_docs).count() == 0
    rows = mixing.apply_mix(odd_docs, mixed).collect()
    words = Counter()
    for r in rows:
        words[r.source] += word_count(r.text)
        assert r.n_chars == len(r.text)
    assert words == Counter({s: n for s, n in taken.items() if n})


def test_schedule_spreads(odd_docs):
    """Any stretch of the schedule holds a source about as often as its share says."""
    d = odd_docs.select("source", mixing.n_words("text").alias("size"))
    src = mixing.source_targets(d).cache()
    slots = sorted(mixing.schedule(src).collect())
    need = Counter(r.sno for r in slots)
    for sno, n in need.items():
        first = sum(r.sno == sno for r in slots[:len(slots) // 2])
        assert abs(first - n / 2) <= 3


# -- 6: personal data --------------------------------------------------------

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub(r"\D", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if (kind == 0 or kind == 1 and all(int(x) < 256 for x in m[0].split("."))
                    or kind == 2 and 12 <= len(d) <= 19 and luhn or kind == 3 and 9 <= len(d) <= 15):
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans():
    rng = random.Random(4)
    parts = ["a@b.com", "x.y+z@q-r.co.uk", "@", "a@@b.c", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "+49 (30) 123-45678",
             "+1", "é", ".", "-", " ", "12", "5555-5555-5555-4444", "a@b", "_", "\n", "+", "(", "0"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(t) == brute_spans(t), t


def test_pii(spark, odd_docs, no_docs):
    rng = random.Random(6)
    mail = lambda: f"{rng.choice('abcxyz')}{rng.randint(1, 99)}@{rng.choice(['mail', 'post'])}.{rng.choice(['com', 'org'])}"
    texts = [f"please write to {mail()} or call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} about the house at the lake "
             f"near number {rng.randint(1, 9999)} where we met at noon. Then came {rng.randint(10**15, 10**16)} of them" for _ in range(300)]
    model = pii.train(texts)
    assert model is not None
    t = "please write to bob77 at mail dot com about the house at the lake"
    got = pii.added_spans([t, "we met at the lake at noon."], [[], []], model)
    assert got[1] == [] and all(t[a:b] == "bob77 at mail dot com" for a, b, _ in got[0])
    df = spark.createDataFrame([(1, texts[0], 3), (2, None, 4), (3, "", 5), (1, texts[0], 3)], "doc_id int, text string, spans int")
    rows = rows_of(pii.find(df, model))
    base = brute_spans(texts[0])
    assert [s[2] for s in base if s[2] in (0, 3)] == [0, 3]
    want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
    assert rows[0] == rows[1] and rows[0][:4:2] == (1, 0) and rows[0][1] == rows[0][4] == 1 and rows[0][6] == want
    assert rows[0][5] == hashlib.sha256(want.encode()).hexdigest()
    assert rows[2] == (2, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    clean = [r.text for r in pii.redact(df, model).orderBy("doc_id").collect()]
    assert clean[2] is None and clean[3] == "" and "[EMAIL]" in clean[0] and "[PHONE]" in clean[0]
    assert pii.find(odd_docs, pii.fit(odd_docs)).count() == odd_docs.count()
    assert pii.find(no_docs, pii.fit(no_docs)).count() == 0


def test_pii_learns_from_all(spark, monkeypatch):
    """Every text's candidates train the trees, in Spark's sums as in the driver's."""
    rng = random.Random(8)
    texts = [f"write to {rng.choice('abcxyz')}{rng.randint(1, 99)}@mail.{rng.choice(['com', 'org'])} or call +1 (212) 555-"
             f"{rng.randint(1000, 9999)} about number {rng.randint(10**15, 10**16)} at noon. Then came {i} of them" for i in range(3500)]
    docs = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(4)
    x, y, _ = pii.examples(texts)
    assert pii.candidate_rows(docs, "text").count() == len(y) > 3000
    class Short(pii.Boosted):
        def __init__(self):
            super().__init__(rounds=4)
    monkeypatch.setattr(pii, "Boosted", Short)
    local = pii.fit(docs)
    monkeypatch.setattr(pii, "LOCAL_VECTORS", 0)
    spread = pii.fit(docs)
    assert len(local.trees.trees) == len(spread.trees.trees) == 4
    np.testing.assert_allclose(local.trees.predict(x), spread.trees.predict(x), atol=1e-9)
    np.testing.assert_allclose(local.thresholds, spread.thresholds, atol=2 / pii.GRID)


def test_long_digits():
    for t in ("1" * 1_000_000, "1." * 300_000, "12.3.4." * 100_000 + "9" * 300_000):
        start = time.time()
        got = [s for s in pii.base_spans(t) if s[2] == 1]
        assert time.time() - start < 10
    assert got[0] == (0, 9, 1) and pii.base_spans("1" * 40 + ".2.3.4") == [] == [s for s in brute_spans("1" * 40 + ".2.3.4")]


def test_disguised_candidates():
    for t in ("write to bob (AT) mail (DOT) com", "write to bob at\nmail dot com", "write to bob [at] mail . com"):
        assert any(k == 0 for _, _, k in pii.candidates(t)), t
    x, y, _ = pii.examples(["write to bob (at) mail (dot) com", "we met at noon. Then"])
    assert len(y) == 1 and not y.any()


# -- 7: language -------------------------------------------------------------


def test_forward_backward():
    rng = np.random.default_rng(0)
    counts = np.array([3, 0, 5, 1])
    s, t = rng.standard_normal((9, 3)), rng.standard_normal((3, 3))
    post, pairs = langid.posteriors(s, counts, t)
    at, want_pairs = 0, np.zeros((3, 3))
    for n in counts:
        mass, pair = np.zeros((n, 3)), np.zeros((3, 3))
        total = 0.0
        for path in np.ndindex(*[3] * n):
            w = np.exp(sum(s[at + i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, y in enumerate(path):
                mass[i, y] += w
            for a, b in zip(path, path[1:]):
                pair[a, b] += w
        if n:
            assert np.allclose(post[at:at + n], mass / total)
            want_pairs += pair / total
        at += n
    assert np.allclose(pairs, want_pairs)


def test_language_id(odd_docs, odd_rows, no_docs):
    import zlib
    got = langid.language_id(odd_docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    by_id = {r.doc_id: r for r in got}
    for r in odd_rows[:60]:
        assert by_id[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 4 == 2)
        if r[0] != 5:
            assert by_id[r[0]].lang_pred == r[2]
    for i in (70, 71, 72, 73):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.language_id(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.language_id(unlabelled).collect()} == {"und"}


def test_code_switching(odd_rows):
    field = langid.train([(r[1], r[2]) for r in odd_rows[:60]])
    f, post = langid.label_words(field, pa.array(["the river and the stone house under der und nicht schön über haus vögel"]))
    labels = [field.langs[i] for i in post.argmax(axis=1)]
    assert labels == ["en"] * 7 + ["de"] * 7


# -- 8: quality --------------------------------------------------------------


def test_quality(odd_docs, odd_rows, no_docs):
    def brute(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = Counter(zip(w, w[1:], w[2:]))
        cover = set()
        for i in range(len(w) - 2):
            if n[tuple(w[i:i + 3])] > 1:
                cover |= {i, i + 1, i + 2}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover),
                len(w) < 50 or 100 * len(cover) > 50 * len(w))
    got = quality.quality(odd_docs)
    assert rows_of(got.drop("kept", "failed_rule")) == sorted(((r[0], *brute(r[1])) for r in odd_rows), key=str)
    assert got.where("base_failed and kept").count() == 0 and got.where("kept").count() > 30
    assert quality.quality(no_docs).count() == 0
    for t in ("a b a b a b", "a a a a a", "x\x85y z", "a\n a\na\nb\n\n", "# * <> |", "a b c d a b c e b c d"):
        d = quality.measure(t)
        assert (len(d.words), d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words) == brute(t)[:5], t


def test_cascade_order(odd_docs):
    slow = lambda d: bool(sum(range(3000))) and False
    order, found = quality.plan(odd_docs, {"slow": slow, "half": lambda d: len(d.words) % 2 == 0})
    assert order == ["half", "slow"] and found["slow"][1] == 0


# -- 9: token counts ---------------------------------------------------------


def test_token_counts(odd_docs, odd_rows, no_docs):
    pieces = token_counts.sentence_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    scores = dict(pieces)

    def brute(word):
        best = [(0.0, 0)] + [None] * len(word)
        for i in range(1, len(word) + 1):
            c = [(best[i - 1][0] + token_counts.BYTE_SCORE, best[i - 1][1] + 1)]
            c += [(best[j][0] + scores[word[j:i]], best[j][1] + 1) for j in range(max(0, i - 48), i) if word[j:i] in scores]
            best[i] = max(c, key=lambda x: (x[0], -x[1]))
        return best[-1][1]

    def count(text):
        words = [token_counts.MARK.encode() + w for w in (text or "").encode().split()]
        return len(words), sum(map(brute, words))
    want = sorted(((r[0], *count(r[1])) for r in odd_rows), key=str)
    assert rows_of(token_counts.token_counts(odd_docs, pieces)) == want
    assert token_counts.token_counts(no_docs, pieces).count() == 0


def test_token_counts_long_words(monkeypatch):
    """Words longer than LONGEST against a Viterbi over the whole word; stretches don't matter."""
    pieces = token_counts.sentence_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    scores, table = dict(pieces), token_counts.Pieces(pieces)
    rng = random.Random(4)

    def brute(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            c = [(best[i - 1][0] + token_counts.BYTE_SCORE, best[i - 1][1] + 1)]
            c += [(best[j][0] + scores[word[j:i]], best[j][1] + 1) for j in range(max(0, i - 48), i) if word[j:i] in scores]
            best.append(max(c, key=lambda x: (x[0], -x[1])))
        return best[-1][1]
    texts = ["é" * 3000, "日本語のテキスト" * 200, "".join(rng.choice(["strasse", "nachricht", "über", "water", "ing"]) for _ in range(400)),
             "".join(rng.choice("abcdefXYZ0189+/") for _ in range(2000)), "x" * 252, "x" * 253, "x" * 254, "the " + "ab" * 500]
    data, offs = utf8(pa.array(texts))
    want = [sum(brute(token_counts.MARK.encode() + w) for w in t.encode().split()) for t in texts]
    for stretch in (65_536, 100, 7):
        monkeypatch.setattr(token_counts, "STRETCH", stretch, raising=False)
        n, words = token_counts.count_batch(data, offs, table)
        assert n.tolist() == want and words.tolist() == [1, 1, 1, 1, 1, 1, 1, 2]


# -- 10: BPE -----------------------------------------------------------------


def test_bpe(spark, odd_docs, odd_rows, no_docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    extra = ["  a  b\n\n c  x don't we'll  ", "x<|endoftext|> y <|endoftext|>", "\n \t z", "日本語 テキスト 🙂 x", "a  b c", "é" * 90 + " " * 40]
    texts = [r[1] for r in odd_rows] + extra
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, ids int")
    got = {r.doc_id: r for r in bpe.encode(df, path, with_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert got[i].ids == raw and got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(bpe.encode(df, path, with_ids=True), path)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.encode(no_docs, path).count() == 0


@pytest.mark.parametrize("kind", ["letters", "digits", "japanese", "one letter", "short and long"])
def test_bpe_long_pretokens(kind, monkeypatch):
    """Pre-tokens of up to a megabyte, in seconds, as the library has them."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(1)
    make = {"letters": lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000)),
            "digits": lambda: "".join(rng.choice("0123456789") for _ in range(1_000_000)),
            "japanese": lambda: "".join(rng.choice("日本語のテキストを切る東京都かなカナ漢字山川") for _ in range(300_000)),
            "one letter": lambda: "a" * 1_000_000,
            "short and long": lambda: " ".join("".join(rng.choice("thein") for _ in range(rng.choice([3, 30, 300]))) for _ in range(3000))}
    text = make[kind]()
    if kind == "short and long":
        monkeypatch.setattr(bpe, "LONG", 25)
    vocab = bpe.Vocabulary(path)
    start = time.time()
    got = np.frombuffer(bpe.Encoder(vocab, bpe.compile_lexicon([], [])).encode([text])[0], "<u4").tolist()
    assert time.time() - start < 60
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_lexicon_is_minimal():
    words = [b"stop", b"top", b"tops", b"stops", b"s", b""]
    blob = bpe.compile_lexicon(words, [np.arange(i, dtype=np.int64) for i in range(len(words))])
    lex = bpe.Lexicon(blob)
    found = lex.lookup(words + [b"to", b"stopss", b"x"])
    assert (found[-3:] == -1).all() and found[5] == -1
    assert [lex.outputs(int(i)).tolist() for i in found[:5]] == [list(range(i)) for i in range(5)]
    assert len(lex.final) == 6  # "", s, st|t.., top and stop share their ends


def test_utf8_of_slices():
    data, offs = utf8(pa.array(["ab", None, "é", ""]).slice(1, 3))
    assert bytes(data) == "é".encode() and offs.tolist() == [0, 0, 2, 2]
