"""Each operator against brute force, on small tables with the awkward rows."""

import hashlib
import importlib
import json
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

P = pytest.importorskip("public_tokenizers")
from lumengrid.llm import bpe, common, components, ctw, decontam, fingerprints, html_text, language, near_dup, pieces, registry, secrets, token_counts, token_files  # noqa: E402

WORDS = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who will more no if out".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + ("." if i % 9 == 0 else "") for i in rng.integers(0, len(WORDS), n))


TEXTS = [None, "", "   \n", "one", prose(1, 40), prose(1, 40), prose(2, 300), prose(3, 4000), "Ünïcode ça été 中文字 😀 \x1c　 x'll don't  \n\n 12½", "<|endoftext|> a", "!!! ###", prose(4, 120), prose(4, 120) + " tail", prose(4, 60)]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.IntegerType()), ("score", T.StringType()), ("rid", T.StringType()), ("cid", T.IntegerType()))])


def table(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, x, "en", "s", None if x is None else len(x), "clash", "clash", 7) for i, x in zip(ids, texts)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, TEXTS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def low(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or "")


def words(x):
    return re.findall(r"[^\x20\x09-\x0D]+", low(x))


def shingles(x):
    w = words(x)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


# op1


def test_token_files(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    path = f"file://{tmp_path}/ids"
    token_files.write(docs, path, P.path("byte_bpe_50k.json"))
    got = {r[0]: tuple(r)[1:] for r in token_files.summarise(spark, path).collect()}
    start, want = 0, {}
    for i, x in enumerate(TEXTS):
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want
    few = {r[0]: list(r[1]) for r in token_files.read_ids(spark, path, [4, 8]).collect()}
    assert few == {i: t.encode(TEXTS[i], add_special_tokens=False).ids + [0] for i in (4, 8)}
    token_files.write(table(spark, [prose(1, 9), prose(2, 9), prose(3, 9), prose(4, 9)], [None, 1, 2, 3]).coalesce(1), f"file://{tmp_path}/nulls", P.path("byte_bpe_50k.json"))
    assert [r[0] for r in token_files.read_ids(spark, f"file://{tmp_path}/nulls", [2]).collect()] == [2]
    assert [r[0] for r in token_files.read_ids(spark, f"file://{tmp_path}/nulls", [None]).collect()] == [None]
    token_files.write(empty, f"file://{tmp_path}/none", P.path("byte_bpe_50k.json"))
    assert token_files.summarise(spark, f"file://{tmp_path}/none").count() == 0


def test_token_files_dictionary():
    body = token_files.train_dictionary([np.random.default_rng(i).integers(0, 50, 400).astype("<u2").tobytes() for i in range(300)])
    assert body and token_files.dict_hash(body) and token_files.train_dictionary([]) == b""


# op2


def components_of(texts, num=85, den=100):
    sets = [shingles(x) for x in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}


def chain(n, step, size=120):
    """Each text shares most words with the one before, and little with those far off."""
    w = [f"w{i}" for i in range(size + n * step)]
    return [" ".join(w[i * step : i * step + size]) for i in range(n)]


def group(n, seed, size=80, most=4):
    rng = np.random.default_rng(seed)
    base = [f"b{seed}x{i}" for i in range(size)]
    out = []
    for k in range(n):
        w = list(base)
        for p in rng.integers(0, size, rng.integers(0, most)):
            w[p] = f"e{k}x{p}"
        out.append(" ".join(w))
    return out


def duplicates(spark, texts, **kw):
    return {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(table(spark, texts).repartition(3), **kw).collect()}


def test_near_duplicates(spark, docs, empty):
    got = {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(docs).collect()}
    assert got == components_of(TEXTS)
    assert near_dup.near_duplicates(empty).count() == 0
    twice = table(spark, ["a b c d e f", "a b c d e f", "x"], [5, 5, None])
    rows = sorted(((r[0], r[2], r[3]) for r in near_dup.near_duplicates(twice).collect()), key=str)
    assert rows == [(5, 5, True), (5, 5, True), (None, None, True)]


def test_near_duplicates_large_groups(spark, monkeypatch):
    for k, v in {"FEW": 2, "WIDE": 8, "UNIT": 12}.items():
        monkeypatch.setattr(near_dup, k, v)
    texts = chain(25, 4) + group(60, 1) + group(40, 2, 60, 6) + [prose(i, 30) for i in range(20)]
    assert duplicates(spark, texts) == components_of(texts)


def test_hyperminhash_estimate():
    rng = np.random.default_rng(0)
    err = []
    for k in range(200):
        pool = common.mix(rng.integers(0, 1 << 62, 1500).astype(np.uint64))
        share = rng.integers(100, 900)
        a, b = np.unique(pool[:1000]), np.unique(pool[1000 - share : 2000 - share])
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        e, _ = near_dup.estimate(near_dup.sketch(a)[None], near_dup.sketch(b)[None], np.array([len(a)]), np.array([len(b)]))
        err.append(e[0] - j)
    assert abs(np.mean(err)) < 0.01 and np.std(err) < 0.06
    x = np.array([0, 1, 1 << 40, (1 << 64) - 1], np.uint64)
    assert (near_dup.sketch(x) > 0).sum() == 2


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r.node, r.label) for r in components.connected(e).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
    assert components.connected(e.where("false")).count() == 0


# op3

SECRET_TEXTS = TEXTS + ["token = \"abcdefghijklmnop\" password: short secret: secret=ABCDEFGHIJKLMN", "AKIA" + "Z" * 16 + " AKIA" + "Z" * 3 + " 😀 0123456789abcdef01 deadbeef", "token: secret: abcdefghijklmnop", "API_KEY=a" + "b" * 40, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "x" * 70000 + " apikey:" + "f" * 30]


def spans(x):
    out = []
    rules = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    for o, (kind, rx, g, least) in enumerate(rules):
        out += [(m.start(), o, m.end(), kind) for m in rx.finditer(x or "") if len(m[g]) >= least]
    return sorted(out)


def test_secrets(spark, empty):
    found = {r.doc_id: [tuple(s) for s in r.found] for r in secrets.scan(table(spark, SECRET_TEXTS).repartition(2), keep=("rid",)).collect()}
    bases = {"assign", "access", "hex"}
    assert {i: [s for s in v if s[3] in bases] for i, v in found.items()} == {i: spans(x) for i, x in enumerate(SECRET_TEXTS)}
    assert [s[3] for s in found[len(TEXTS) + 4]] == ["private_key"] and "github" in {s[3] for s in found[len(TEXTS) + 5]}
    assert secrets.scan(empty).count() == 0
    assert secrets.scan(table(spark, ["token=abcdefghijklmnop"] * 2, [None, None])).where(F.size("found") == 1).count() == 2


@pytest.mark.parametrize("regex,want", [("abcd", [{"abc", "bcd"}]), ("[0-9a-f]+", [set()]), ("(abc|xyz)k", [{"abc", "bck"}, {"xyz", "yzk"}]), ("ab?c*de", [set()]), ("foo.*bar", [{"foo", "bar"}])])
def test_trigram_query(regex, want):
    assert sorted(map(sorted, secrets.trigram_query(regex))) == sorted(map(sorted, want))


# op4


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def test_bpe_query(spark, docs, empty, tik):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r[0]: tuple(r)[1:] for r in bpe.round_trip(docs, path, P.PATTERN).collect()}
    want = {}
    for i, x in enumerate(TEXTS):
        ids = tik[0].encode_ordinary(x or "")
        want[i] = (len(ids), sha(",".join(map(str, ids)).encode()), sha((x or "").encode()))
    assert got == want
    assert bpe.round_trip(empty, path, P.PATTERN).count() == 0
    back = {r[0]: r[1] for r in bpe.decode(bpe.encode(docs, path, P.PATTERN), path, P.PATTERN).collect()}
    assert back == {i: x or "" for i, x in enumerate(TEXTS)}


def test_bpe_fuzz(tik):
    import random

    rng = random.Random(5)
    bits = ["a", "the", "é", "中", " ", "\n", "'s", "1", "!", "😀", "ing", "q", "zz", "\t", "¼", "\x85"]
    for _ in range(1500):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        ids = tik[1].encode(s)
        assert ids.tolist() == tik[0].encode_ordinary(s)
        assert tik[1].decode(ids, rng.randint(1, 4)) == s.encode()
    assert tik[1].encode("a" * 3000).tolist() == tik[0].encode_ordinary("a" * 3000)


def test_transducer_forgets(tik):
    t = bpe.Transducer(bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), most_states=5)
    for w in (b" thereabouts", b" whatsoever", b" thereupon") * 3:
        assert t.encode(w) == t.merged(w) or w in t.ranks


def test_stream_decoder_bad_bytes(tik):
    raw = bytes([0xE4, 0xB8, 0x41, 0xFF, 0xC3, 0xA9, 0xF0, 0x9F])
    ids = np.array([tik[0].encode_single_token(bytes([b])) for b in raw])
    assert tik[1].decode(ids, 1) == raw
    for s in range(8):
        assert all(bpe.Utf8Machine.step(s, b) in range(-1, 8) for b in range(256))


# op5


def test_ctw(spark, docs, empty, monkeypatch):
    def run(**consts):
        for k, v in consts.items():
            monkeypatch.setattr(ctw, k, v)
        return {r.doc_id: r for r in ctw.score(docs, F.col("doc_id") % 5 != 1).collect()}

    got = run()
    counts, n = Counter(), 0
    for i, x in enumerate(TEXTS):
        if i % 5 != 1:
            counts.update(words(x))
            n += 1
    total, kinds = sum(counts.values()) + n, len(counts) + 1
    for i, x in enumerate(TEXTS):
        each = [counts[w] for w in words(x)] + [n]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(each), sum(c > 0 for c in each), total, i % 5 == 1)
        assert math.isclose(r.base_score, sum(math.log10((c + 0.5) / (total + 0.5 * (kinds + 1))) for c in each), rel_tol=1e-9)
        assert r.score < 0
    split = run(CHUNK=300, MERGE=10, SPREAD=20)
    assert all(math.isclose(got[i].score, split[i].score, rel_tol=1e-9) and math.isclose(got[i].base_score, split[i].base_score, rel_tol=1e-9) and got[i].n_known == split[i].n_known for i in got)
    assert ctw.score(empty, F.lit(True)).count() == 0
    assert ctw.score(docs, F.lit(False)).where("held_out").count() == len(TEXTS)


def brute_ctw(train, depth=5):
    """log10 P(text) by trees in dictionaries, node by node, as the definition has it."""
    count = defaultdict(lambda: [0, 0])

    def steps(text):
        raw = b"\0" * depth + (text or "").encode() + b"\xff"
        for i in range(depth, len(raw)):
            for b in range(8):
                yield raw[i - depth : i], (raw[i] | 256) >> (8 - b), raw[i] >> (7 - b) & 1

    for x in train:
        for ctx, prefix, bit in steps(x):
            for d in range(depth + 1):
                count[ctx[depth - d :], prefix][bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    kids = defaultdict(float)
    weight = {}
    for d in range(depth, -1, -1):
        for (ctx, prefix), (a, b) in [x for x in count.items() if len(x[0][0]) == d]:
            pe, below = kt(a, b), kids[ctx, prefix]
            pw = pe if d == depth else math.log(0.5) + max(pe, below) + math.log1p(math.exp(-abs(pe - below)))
            weight[ctx, prefix] = 1.0 if d == depth else math.exp(math.log(0.5) + pe - pw)
            if d:
                kids[ctx[1:], prefix] += pw

    def predict(ctx, prefix, bit):
        mixed, left, found = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            node = ctx[depth - d :], prefix
            if node not in weight:
                break
            p = (count[node][bit] + 0.5) / (sum(count[node]) + 1)
            found, mixed, left = mixed + left * p, mixed + left * weight[node] * p, left * (1 - weight[node])
        return found

    return lambda text: sum(math.log10(predict(*x)) for x in steps(text))


def test_ctw_against_brute_force(spark):
    texts = [prose(i, 40) for i in range(12)] + ["ab " * 60 + "Qz", None, "", "Qzé中", "x", prose(3, 40)]
    score = brute_ctw([x for i, x in enumerate(texts) if i % 3])
    got = {r.doc_id: r.score for r in ctw.score(table(spark, texts).repartition(3), F.col("doc_id") % 3 != 0).collect()}
    assert all(math.isclose(got[i], score(x), rel_tol=1e-6) for i, x in enumerate(texts))
    blank = brute_ctw([])
    none = {r.doc_id: r.score for r in ctw.score(table(spark, texts), F.lit(False)).collect()}
    assert all(math.isclose(none[i], blank(x), rel_tol=1e-6) for i, x in enumerate(texts))


def test_ctw_is_a_distribution():
    raw, off = common.text_bytes(pa.array([prose(i, 200) for i in range(20)]))
    keys, n = ctw._merge(*zip(*(ctw._tally(c, np.zeros(len(c), bool)) for c, _ in ctw.pieces(raw, off)), strict=True))
    for context in (b"\0\0\0\0\0", b"at th", b"zzzzz"):
        code = np.array([int.from_bytes(context[::-1] + bytes([s]), "big") for s in range(256)], np.uint64)
        every, count = ctw._merge([keys, code], [n, np.zeros(256, np.int64)])
        below, top = ctw.subtrees(every, count)
        p = 10 ** ctw.Top(*(x.astype(np.uint64) if i == 0 else x for i, x in enumerate(top))).log10(every, below)
        assert math.isclose(p[np.searchsorted(every, code)].sum(), 1.0, rel_tol=1e-5)


def test_gram_pieces(monkeypatch):
    raw, off = common.text_bytes(pa.array(["", "abcdefghij", None, "é", "xy" * 9]))
    whole = [np.concatenate(x) for x in zip(*ctw.pieces(raw, off), strict=True)]
    monkeypatch.setattr(ctw, "PIECE", 3)
    cut = [np.concatenate(x) for x in zip(*ctw.pieces(raw, off), strict=True)]
    assert all(np.array_equal(x, y) for x, y in zip(whole, cut, strict=True))
    assert int(whole[0][3]) == int.from_bytes(b"cba\0\0d", "big") and len(whole[0]) == len(raw) + 5


def test_kt_block():
    assert math.isclose(ctw.kt_block(np.array([2]), np.array([1]))[0], math.log(0.5 * 0.75 * (0.5 / 3)))
    assert np.allclose(ctw.kt_block(np.array([5000]), np.array([7000])), math.lgamma(5000.5) + math.lgamma(7000.5) - math.lgamma(12001) - math.log(math.pi))


# op6

ARTICLE = "<article><h1>T &amp; x</h1><p>a<b>b</b>  c&nbsp;d<br>e<p>f<div class='ad'>buy</div><section id=comments><p>no</section><aside>q</aside></article>"


def test_html(spark):
    page = lambda body: f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a>n</a></nav><header>h</header>{body}<form>f</form><footer>z</footer><script>if (a < b) '</p>'</script></body>"
    rows = [
        (1, "http://a.x/1", page(ARTICLE), "c"),
        (2, "http://a.x/2", page("<div>Same line</div><p>Own line one"), "c"),
        (3, "http://a.x/3", page("<div>Same line</div><p>Own line two"), "c"),
        (4, None, None, "c"),
        (5, "http://b.x/", "<p>alone &lt;b&gt;", "c"),
        (5, "http://b.x/", "<p>alone &lt;b&gt;", "c"),
        (None, "http://c.x/", "<article>cut <b>off", "c"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(df).collect()))
    want = [(0, "cut off"), (1, "T & x ab c d e f"), (2, "Own line one"), (3, "Own line two"), (4, ""), (5, "alone <b>"), (5, "alone <b>")]
    assert [g[:2] for g in got] == want and all(len(t) == n for _, t, n in got)
    assert html_text.extract(df.where("false")).count() == 0


def test_differencing_decides_in_articles(spark):
    page = lambda title, body: f"<title>{title}</title><nav>n</nav><p>Skip</p>{body}"
    article = lambda *ps: "<article>" + "".join(f"<p>{p}</p>" for p in ps) + "</article>"
    teaser = "<div class='related'><article><p>Read this too, it is a longer text than the page's own</p></article></div>"
    rows = [
        # A line that the neighbour's article has too goes, a loose line of this page only stays.
        (1, "http://a.x/1", page("One", article("One", "First text of some length", "All rights reserved.") + "<p>Dated Monday</p>")),
        (2, "http://a.x/2", page("Two", article("One", "Two", "Second text of some length", "All rights reserved."))),
        # Copies keep their lines.
        (3, "http://b.x/1", page("C", article("C", "Copied text", "All rights reserved."))),
        (4, "http://b.x/2", page("C", article("C", "Copied text", "All rights reserved."))),
        # An article in a marked part is not the page's, unless there is nothing else.
        (5, "http://c.x/1", page("D", article("D", "Own text") + teaser)),
        (6, "http://d.x/1", f"<div class='layout has-sidebar'>{article('Only text')}</div>"),
        # Without a neighbour structure alone decides.
        (7, "http://e.x/1", page("E", article("E"))),
    ]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    assert got == {1: "One First text of some length Dated Monday", 2: "Two Second text of some length", 3: "C Copied text All rights reserved.", 4: "C Copied text All rights reserved.", 5: "D Own text", 6: "Only text", 7: "E"}


def test_ranges_do_not_matter(spark):
    # Each page shares a line with the one before it and another with the one after it.
    rows = [(i, f"http://a.x/{i:03}", f"<p>s{i - 1}</p><p>s{i}</p><p>own {i}</p>") for i in range(40)]
    names = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got == {0: "s-1 own 0", **{i: f"own {i}" for i in range(1, 39)}, 39: "s39 own 39"}


def test_broken_pages_are_read_in_linear_time():
    n = 100_000
    for html in ("<a " * n, '<a "' * n, "<b>" * n + "</i>" * n, "<p>" + "<b>" * n + "<div>" * n, "<x><div>" + "<b>" * n + "</x>" * n, "<b>" * n + "<p>" * n):
        began = time.perf_counter()
        html_text.page_lines(html)
        assert time.perf_counter() - began < 10
    assert html_text.common_lines(["a"] * 4000 + ["b"], ["c"] + ["a"] * 4000) == set(range(4000))


def test_common_lines_halved(monkeypatch):
    monkeypatch.setattr(html_text, "TABLE", 4)
    test_common_lines()


def test_common_lines():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = (list(map(str, rng.integers(0, 4, rng.integers(0, 12)))) for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(html_text.common_lines(a, b)) == best[-1][-1]


# op7


def test_decontamination(spark, docs, empty):
    items = [(1, prose(50, 30)), (2, "two words"), (3, None), (4, prose(51, 90)), (5, prose(4, 60)), (5, prose(4, 60)), (6, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    half = prose(51, 90).split()
    texts = TEXTS + [prose(60, 500) + " " + prose(50, 30).upper() + " " + prose(61, 500), "Some two, words.", " ".join(half[:40]), " ".join(half[:80])]
    norm = lambda x: [w for w in re.split(r"[\W_]+", (x or "").lower()) if w]

    def runs(x, n):
        w = norm(x)
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want = set()
    for item, x in items:
        n = min(5, len(norm(x)))
        if n:
            s = runs(x, n)
            want |= {(i, item) for i, t in enumerate(texts) if len(s & runs(t, n)) >= 0.8 * len(s)}
    got = decontam.search(table(spark, texts).repartition(2), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) and want
    assert decontam.search(empty, bench).count() == 0 and decontam.search(docs, bench.where("false")).count() == 0


# op8


def test_astral_symbols_are_no_letters(spark):
    model = language.fit_texts({"en": ["the cat sat on the mat"], "de": ["der Hund und die Katze"]})
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in language.predict(table(spark, ["\U0001f600 123", "\U0001f600", "the cat \U0001f600", "\U00010400"]), model).collect()}
    assert got[0] == got[1] == ("und", False) and got[2] == ("en", True) and got[3][0] != "und"



def test_language(spark, empty):
    alphabets = {"aa": "abcde", "bb": "defgh", "cc": "hijka"}
    rng = np.random.default_rng(0)
    make = lambda lang, n: " ".join("".join(rng.choice(list(alphabets[lang]), 4)) for _ in range(n))
    rows = [(i, make(lang, 60), lang) for i, lang in enumerate([*alphabets] * 40)] + [(1000, None, "aa"), (1001, "123 !!", None), (1002, "", None), (None, make("bb", 50), None)]
    d = spark.createDataFrame([(i, x, y, "c") for i, x, y in rows], "doc_id long, text string, lang string, lang_pred string").repartition(3)
    got = language.identify(d).collect()
    known = {r: y for r, _, y in rows[:120]}
    assert len(got) == len(rows) and np.mean([r.lang_pred == known[r.doc_id] for r in got if r.doc_id in known]) > 0.98
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1000, 1001, 1002} and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert language.identify(empty).count() == 0
    assert {r.lang_pred for r in language.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_cross_parsing():
    m = language.fit_texts({"x": ["abracadabra " * 3], "y": ["zyxwvut " * 3]})
    text = language.normal(language.code_points("abra cad zyx qq"))
    auto = {lang: {"".join(map(chr, language.normal(language.code_points(t))))} for lang, t in (("x", "abracadabra " * 3), ("y", "zyxwvut " * 3))}
    for k, lang in enumerate(m.langs):
        (learned,) = auto[lang]
        n, at, s = 0, 0, "".join(map(chr, text))
        while at < len(s):
            end = at + 1
            while end < len(s) and s[at : end + 1] in learned:
                end += 1
            n, at = n + 1, end
        assert language.phrases(m, [text])[0, k] == n


# op9


def test_token_counts(spark, docs, empty, tmp_path):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = {i: (len((x or "").encode()), len(sp.encode(x or "")), len(sp.encode(x or "")) > 100) for i, x in enumerate(TEXTS)}
    cache = f"file://{tmp_path}/cache"
    for _ in range(2):
        assert {r[0]: tuple(r)[1:] for r in token_counts.token_counts(docs, path, cache, limit=100).collect()} == want
    stored = token_counts.read_cache(spark, cache, token_counts.tokenizer_version(path))
    assert stored.count() == stored.select("digest").distinct().count() == len({x or "" for x in TEXTS})
    assert token_counts.token_counts(empty, path, cache).count() == 0


# op10


def test_fingerprints(spark, docs, empty):
    got = {r.doc_id: r for r in fingerprints.compare_with_edits(docs).collect()}
    order = list(range(len(TEXTS)))[::-1]
    for k, i in enumerate(order):
        x, nxt = TEXTS[i] or "", TEXTS[order[(k + 1) % len(order)]] or ""
        e, r = fingerprints.edited_text(x, nxt), got[i]
        assert r.n_chars == len(x) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        for a, b, near in ((x, e, r.near_edited), (x, nxt, r.near_next)):
            s, t = shingles(a), shingles(b)
            assert abs(near - (len(s & t) / len(s | t) if s | t else 1.0)) < 0.12
    assert got[4].fingerprint == got[5].fingerprint and len(got[4].fingerprint) == fingerprints.BINS * fingerprints.BITS // 4
    assert fingerprints.compare_with_edits(empty).count() == 0
    assert fingerprints.compare_with_edits(docs.where("doc_id = 7")).first().near_next == 1.0
    assert fingerprints.compare_with_edits(table(spark, ["a", "b", "c"], [3, 3, None])).count() == 3
    assert fingerprints.fingerprint(docs).count() == len(TEXTS)


def test_pack_and_densify():
    rng = np.random.default_rng(2)
    for bits in (1, 2, 4, 8):
        v = rng.integers(0, 1 << bits, 64).astype(np.uint8)
        assert np.array_equal(fingerprints.unpack(fingerprints.pack(v, bits), 64, bits), v)
    for n in (1, 30, 100, 400, 5000):
        s = np.unique(common.mix(rng.integers(0, 1 << 62, n).astype(np.uint64)))
        # Bin by bin: the least hash, or that of the first filled bin in the bin's own order, low bits only.
        bins, bits = fingerprints.BINS, fingerprints.BITS
        order = fingerprints._orders(bins)[0].tolist()
        least = {}
        for h in s.tolist():
            b = h >> (64 - bins.bit_length() + 1)
            least[b] = min(h, least.get(b, h))
        source = [least[next(x for x in [b, *order[b]] if x in least)] for b in range(bins)]
        mixed = common.mix(np.array(source, np.uint64) + np.arange(bins, dtype=np.uint64) * common.GOLDEN)
        assert np.array_equal(fingerprints.sketch(s), (mixed & np.uint64((1 << bits) - 1)).astype(np.uint8))


def test_fingerprints_of_string_ids(spark):
    rows = spark.createDataFrame([(f"d{i:03}" if i else None, prose(i, 30)) for i in range(40)], "doc_id string, text string")
    order = [f"d{i:03}" for i in range(39, 0, -1)] + [None]
    want = {r.doc_id: r.text for r in rows.collect()}
    got = {r.doc_id: r for r in fingerprints.compare_with_edits(rows).collect()}
    for k, x in enumerate(order):
        e = fingerprints.edited_text(want[x], want[order[(k + 1) % 40]])
        assert got[x].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()


# pieces and the pipeline


def test_pieces():
    import regex

    rx, rng = regex.compile(P.PATTERN), np.random.default_rng(3)
    bits = np.array(["'", "s", "re", "ll", " ", "  ", "\n", "1", "½", "!", "é", "a", "'ve"])
    for _ in range(500):
        x = "".join(rng.choice(bits, rng.integers(1, 15)))
        raw = x.encode("latin-1")
        at = [*pieces.boundaries(np.frombuffer(raw, np.uint8), [0, len(raw)]).tolist(), len(raw)]
        assert [raw[a:b].decode("latin-1") for a, b in zip(at, at[1:])] == rx.findall(x)


def test_pipeline(spark, tmp_path):
    cp = importlib.import_module("corpus_pipeline")
    bench = spark.createDataFrame([(1, prose(50, 30))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["123", None, prose(1, 80), prose(1, 80), prose(2, 90) + " token=abcdefghijklmnop end", prose(3, 60) + " " + prose(50, 30)]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in cp.run(spark, str(tmp_path)).collect()}
    assert set(out) == {2, 4}  # no letters, no text, a copy and a benchmark passage go
    import tiktoken

    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert list(out[4].ids) == enc.encode_ordinary(prose(2, 90) + f" {cp.MASK} end")
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "byte_bpe"]
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        got = stage(spark, d, str(tmp_path))
        assert got.columns == d.columns
        assert stage(spark, d.where("false"), str(tmp_path)).count() == 0


def test_registry():
    assert {re.match(r"op(\d+)_", n)[1] for n in registry.QUERIES} == {str(i) for i in range(1, 13)}
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    json.dumps(registry.ORACLES)
