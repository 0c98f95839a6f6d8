"""The text operators on small tables, edge cases included, against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import bitpack, bpe, common, components, fertility, fixity, langid, mixing, neardup, quality, textstats, toxicity, winnow

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size int, row string"
SYLLABLES = "the an er in on re th nd ti le qu ou ez ar".split()


def make_text(r, n):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, nulls, an empty and a blank text, an unspaced long one, a repeated row, and columns that clash."""
    r = random.Random(5)
    texts = [make_text(r, r.randint(1, 200)) for _ in range(60)]
    base = make_text(r, 120).split()
    for i in range(12):
        near = list(base)
        near[i * 7] = f"changed{i}"
        texts.append(" ".join(near))
    texts += [texts[3], texts[3].upper(), None, "", " \n\t ", "é" * 5000, "x\ny\nx\nx", "123 456", "日本語 テキスト", "a<|endoftext|>b"]
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "s1", "s2", "s1", "hot")[i % 5], len(t or ""), 0.5, 1, "r") for i, t in enumerate(texts)]
    rows.append(rows[10])
    rows.append((None, "no id here at all", "en", "s1", 5, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 3 > 0, None if i == 4 else int(i % 4 == 0)) for i in range(60)], "doc_id long, q boolean, toxic int").select("doc_id", F.col("q").cast("int").alias("quality"), "toxic")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sets, {i: root(i) for i in ids}


def test_spans_and_statistics():
    for text in ("", " ", "a", "  b c\n", "é x é", "a b c d e a b c d e f"):
        h, s, n = common.spans(text.encode())
        assert len(h) == len(words(text)) and len(set(h.tolist())) == len(set(words(text)))
    big = ("ab cd\n" * 300_000 + "x" * 2_500_000 + " end").encode()
    assert len(set(common.spans(big)[0].tolist())) == 4
    assert common.spans(b"ABC", lower=True)[0][0] == common.spans(b"abc")[0][0]
    assert textstats.repeated_words(common.spans(b"a b c d e a b c d e")[0]) == 10
    assert textstats.repeated_lines(b"x\ny\nx\n\n\n \n \nx") == 2


def brute_layout(rows):
    """(file, offset) -> (sha, length, copies, page_id) for (page_id, url, html) rows, by the definition."""
    runs = Counter()
    for i, url, html in rows:
        url, html = url or "", html or ""
        h = hashlib.md5(f"{'' if i is None else i}\n{url}".encode()).hexdigest()
        uuid = "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:]))
        head = ["WARC/1.0", "WARC-Type: resource", f"WARC-Record-ID: <urn:uuid:{uuid}>", f"WARC-Date: {fixity.WARC_DATE}", f"WARC-Target-URI: {url}", "Content-Type: text/html", f"Content-Length: {len(html.encode())}"]
        record = ("\r\n".join(head) + "\r\n\r\n" + html + "\r\n\r\n").encode()
        runs[(i is not None, i or 0, hashlib.sha256(record).hexdigest(), len(record))] += 1
    out, at = {}, Counter()
    for (known, i, sha, n), c in sorted(runs.items()):
        file = i >> fixity.FILE_BITS if known else None
        out[(file, at[file])] = (sha, n, c, i if known else None)
        at[file] += n * c
    return out


def brute_audit(a, b):
    out = []
    for place in a.keys() | b.keys():
        x, y = a.get(place), b.get(place)
        if (x or y)[:3] != (y or x)[:3] or not x or not y:
            status = "extra" if not x else "missing" if not y else "altered"
            out.append((*place, (x or y)[3], status, x and x[0], y and y[0], (x or y)[1], x[2] if x else 0, y[2] if y else 0))
    return Counter(out)


def test_fixity(spark):
    r = random.Random(1)
    rows = [(i, f"http://x/{i}", make_text(r, 5)) for i in range(300)] + [(7, "http://x/7", "again"), (8, "u", "dup"), (8, "u", "dup"), (None, None, None), (10**12, "far", "é" * 300_000), (-5, "minus", "")]
    rows += [(50, "hot", f"{k}") for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("clash"))
    want = brute_layout(rows)
    lay = fixity.layout(pages)
    # the null id's file has a number inside
    got = {(None if x["file"] == fixity.NO_FILE else x["file"], x["offset"]): (x["record_sha256"], x["length"], x["copies"], x["page_id"]) for x in lay.collect()}
    assert got == want
    place = {v[3]: k for k, v in want.items()}
    audited = lambda a, b: Counter(tuple(x) for x in fixity.audit(a, b).collect())
    assert not audited(lay, fixity.layout(pages.repartition(7)))
    # one damaged byte, one lost record, two of one size swapped, one moved: all found, each at its place
    frame = lambda d: spark.createDataFrame([(fixity.NO_FILE if f is None else f, o, n, c, sha, "", i) for (f, o), (sha, n, c, i) in d.items()], lay.schema)
    bad = dict(want)
    x, y, z, m = (place[i] for i in (20, 30, 31, 40))
    bad[x] = ("0" * 64, *want[x][1:])
    bad[y], bad[z] = want[z], want[y]
    bad[(m[0], 10**9)] = bad.pop(m)
    del bad[place[41]], bad[place[None]]
    found = audited(lay, frame(bad))
    assert found == brute_audit(want, bad) and len(found) == 7
    assert audited(frame(bad), lay) == brute_audit(bad, want)
    assert audited(lay, frame({k: v for k, v in bad.items() if k[0] == 0})) == brute_audit(want, {k: v for k, v in bad.items() if k[0] == 0})
    # another number of copies
    more = want | {place[8]: (*want[place[8]][:2], 5, 8)}
    assert audited(lay, frame(more)) == brute_audit(want, more)
    none = lay.where("offset < 0")
    assert not audited(none, none) and sum(audited(lay, none).values()) == len(want) == sum(audited(none, lay).values())
    out = Counter((x["status"], x["page_id"]) for x in fixity.op1_merkle_audit(pages).collect())
    assert out[("altered", 13)] == 1 and out[("missing", 41)] == 1 and out[("extra", 73)] == 1 and sum(n for (_, i), n in out.items() if i in (29, 30)) >= 2
    assert not any(i in (None, 7, 8, 50, -5) for _, i in out)
    assert fixity.op1_merkle_audit(pages.where("page_id = -77")).count() == 0


def signed_long_hash(i):
    """Spark's xxhash64 of a long."""
    h = xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), seed=42)
    return h - 2**64 if h >= 2**63 else h


def brute_maximal(scores):
    """All maximal scoring segments by their recursive definition."""
    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 0 and (top is None or total > top[0] + 1e-12):
                    top = (total, i, j + 1)
        return top

    out = []

    def split(a, b):
        if a < b and (t := best(a, b)):
            out.append((t[1], t[2], round(t[0], 6)))
            split(a, t[1]), split(t[2], b)

    split(0, len(scores))
    return sorted(out)


def test_maximal_segments():
    r = random.Random(3)
    for _ in range(200):
        scores = [r.choice([-3.5, -2.25, -1.125, 1.0625, 2.5, 4.03125]) + r.random() / 64 for _ in range(r.randint(0, 14))]
        got = sorted((a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(np.array(scores)))
        assert got == brute_maximal(scores)


def brute_toxic_score(text, model):
    """A document's score by the definition: segments by recursion, their expectation by the law."""
    w = re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())
    scores = [model.weights.get(x.encode(), model.other) for x in w]
    evidence = [np.log(toxicity.EXPECTED / (model.scale * len(w) * np.exp(-model.rate * s))) for _, _, s in brute_maximal(scores)] if any(x > 0 for x in scores) else []
    if not evidence:
        return 0.0
    return 1 / (1 + np.exp(-min(sum(x for x in evidence if x > 0) or max(evidence), 50.0)))


def test_toxicity(spark, docs, empty, labels):
    r = random.Random(2)
    rows = [(make_text(r, 80) + (" you vile pathetic scum, vile scum!" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    model = toxicity.train(rows[:300])
    assert {b"vile", b"scum", b"pathetic"} <= set(model.weights)
    # a weight is the log-odds of the token among the tokens of either class, smoothed by its share of both
    count = lambda y: Counter(w for t, z in rows[:300] if z == y for w in toxicity.tokens(t))
    n = [sum(count(y).values()) for y in (0, 1)]
    a, share = count(1)[b"vile"], count(1)[b"vile"] / sum(n)
    x1, x0 = a + share * n[1], share * n[0]
    assert model.weights[b"vile"] == pytest.approx(np.log(x1 / (2 * n[1] - x1)) - np.log(x0 / (2 * n[0] - x0)))
    score = lambda t: toxicity.document_score(toxicity.all_segments(t, model))
    assert np.mean([int(score(t) >= 0.5) == y for t, y in rows[300:]]) > 0.97
    assert score(None) == 0.0 == score("")
    for t, _ in rows[300:]:
        part = " ".join(t.split()[-40:])
        assert score(part) == pytest.approx(brute_toxic_score(part, model), abs=1e-6)
    # one weak word in a long text stays below the threshold, and the shorter the text the higher
    weak = toxicity.Model({b"bad": 1.5}, -0.1, 2.0, 0.5)
    ranked = [toxicity.document_score(toxicity.all_segments("bad " + "word " * k, weak)) for k in (1000, 100, 30, 2)]
    assert ranked == sorted(set(ranked)) and 0 < ranked[0] < ranked[1] < 0.5 < ranked[3]
    # the query against brute force, on texts that fit it, with a very long one
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)] + [(1000, "word " * 300_000 + "vile scum vile"), (1001, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int")
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    order = sorted((i for i in range(400) if fold(i)), key=lambda i: signed_long_hash(i))
    model = toxicity.train([rows[i] for i in order])
    out = {x["doc_id"]: x for x in toxicity.op2_toxic_segments(table, marks).collect()}
    assert len(out) == 402 and out[1000]["score"] == pytest.approx(toxicity.document_score(toxicity.all_segments("word " * 300_000 + "vile scum vile", model)))
    for i, (t, _) in enumerate(rows):
        assert out[i]["score"] == pytest.approx(toxicity.document_score(toxicity.all_segments(t, model)), abs=1e-9) and out[i]["held_out"] == (fold(i) == 0)
    out = toxicity.op2_toxic_segments(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5) for x in out)
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0) for x in out if x["doc_id"] is not None)
    assert toxicity.op2_toxic_segments(empty, labels).count() == 0
    assert {x["score"] for x in toxicity.op2_toxic_segments(docs, labels.limit(0)).collect()} == {0.0}
    clash = toxicity.with_segments(docs.select("text", F.lit(1).alias("found"), F.lit(2).alias("_r"), F.lit(3).alias("toxic_score")), model)
    assert clash.columns == ["text", "found", "_r", "toxic_segments", "toxic_score"] and {(x["found"], x["_r"]) for x in clash.collect()} == {(1, 2)}


def test_toxicity_held_out(spark):
    """Held-out documents of a scale factor: few clean ones are called toxic, and the score ranks."""
    sf = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.op2_toxic_segments(spark.read.parquet(f"{sf}/documents.parquet"), marks).where("held_out").join(marks, "doc_id").select("toxic", "score").collect()
    bad, good = ([x["score"] for x in out if x["toxic"] == y] for y in (1, 0))
    assert np.mean([s >= 0.5 for s in bad]) > 0.9 and np.mean([s >= 0.5 for s in good]) < 0.02
    assert np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good]) > 0.95


def test_near_duplicates_of_a_scale_factor(spark):
    """All links of a whole table, found by brute force, and no other component."""
    rows = [(x["doc_id"], x["text"]) for x in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    sets = {i: neardup.shingles(t) for i, t in rows}
    ids, parent, links = sorted(sets), {i: i for i in sets}, 0

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        x = sets[a]
        for b in ids[n + 1 :]:
            y = sets[b]
            if not len(x) or not len(y) or 100 * min(len(x), len(y)) < 75 * max(len(x), len(y)) or not (x[:32].min() <= y.max() and y.min() <= x.max()):
                continue
            common_ = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common_ >= 75 * (len(x) + len(y) - common_):
                links, p, q = links + 1, root(a), root(b)
                parent[max(p, q)] = min(p, q)
    assert links > 100
    out = {x["doc_id"]: x for x in neardup.op3_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all((out[i]["n_shingles"], out[i]["component_id"], out[i]["kept"]) == (len(sets[i]), root(i), root(i) == i) for i in ids)


def test_sketches_bound_differences():
    """Sketches of any two sets differ in no more bits than the sets differ in members, at every length; signatures within the bound share a posting."""
    r = np.random.default_rng(3)
    for n in (1, 40, 300, 5000):
        base = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        for changed in (0, 1, n // 8, n // 2):
            other = np.unique(np.concatenate([base[changed:], r.integers(0, 2**63, changed + changed // 2, dtype=np.uint64)]))
            apart = len(np.setxor1d(base, other))
            x, y = neardup.sketch(base), neardup.sketch(other)
            assert np.bitwise_count((neardup.folded(x) ^ neardup.folded(y)).view(np.uint64)).sum() <= apart
            while len(x) > len(y):
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            while len(y) > len(x):
                y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= apart
    for _ in range(300):
        a = r.integers(0, 2**16, neardup.SYMBOLS)
        b = a.copy()
        b[r.choice(neardup.SYMBOLS, neardup.INDEX_DISTANCE, replace=False)] += 1
        assert any(all(a[k] == b[k] for k in kept) for kept in neardup.SELECTIONS)


def test_near_duplicates(docs, empty):
    rows = [(x["doc_id"], x["text"]) for x in docs.collect() if x["doc_id"] is not None]
    sets, roots = brute_components(rows)
    out = neardup.op3_near_duplicates(docs).collect()
    assert len(out) == docs.count()
    for x in out:
        if x["doc_id"] is None:
            assert x["component_id"] is None and x["kept"]
        else:
            assert (x["n_shingles"], x["component_id"], x["kept"]) == (len(sets[x["doc_id"]]), roots[x["doc_id"]], roots[x["doc_id"]] == x["doc_id"]), x["doc_id"]
    assert neardup.op3_near_duplicates(empty).count() == 0
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(x["doc_id"] for x in kept.where("doc_id is not null").collect()) == sorted({i for i in roots if roots[i] == i})


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 90), (7, 7), (90, 100)], "a long, b long")
    got = {x["node"]: x["component"] for x in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(51)}, 90: 90, 100: 90}


def test_gated_network_learns():
    r = np.random.default_rng(0)
    net = langid.blank(["a", "b", "c"])
    for p in (net.inputs, net.recurrent):
        for i in (0, 1):
            p[i] = p[i].astype(np.float64)
    x, y, mask = r.integers(0, 256, (6 + 2 * langid.CONTEXT, 5)).astype(np.uint8), r.integers(0, 3, 5), np.ones((6, 5), np.float32)
    mask[4:, 2] = 0
    _, grads = langid.gradients(net, x, y, mask)
    for p, g in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        held, step = p[at], 1e-2
        p[at] = held + step
        up = langid.gradients(net, x, y, mask)[0]
        p[at] = held - step
        down = langid.gradients(net, x, y, mask)[0]
        p[at] = held
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.05)
    rnd = random.Random(4)
    make = lambda s: " ".join("".join(rnd.choice(s) for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(3, 60)))
    rows = [(make("abcdefg") if i % 2 else make("éèêlmno"), "x" if i % 2 else "y") for i in range(200)]
    trained = langid.train(rows[:150], updates=40)
    p = langid.probabilities(trained, [t for t, _ in rows[150:]] + [""])
    assert all(trained.languages[k] == lang for k, (_, lang) in zip(p.argmax(axis=1), rows[150:], strict=False)) and p[-1].sum() == 0


def brute_network(net, data):
    """Probabilities of every position, byte by byte, window by window, by the equations."""
    logistic = lambda v: 1 / (1 + np.exp(-v))

    def step(k, state, byte):
        h = langid.UNITS
        w, u = net.inputs[k][:, byte].astype(float), net.recurrent[k].astype(float)
        z, r = logistic(w[:h] + u[:h] @ state), logistic(w[h : 2 * h] + u[h : 2 * h] @ state)
        n = np.tanh(w[2 * h :] + r * (u[2 * h :] @ state))
        return (1 - z) * n + z * state

    at = lambda i: data[i] if 0 <= i < len(data) else 0
    out = []
    for low in range(0, len(data), langid.STEPS):
        high = low + langid.STEPS
        states = {}
        for k, places in ((0, range(low - langid.CONTEXT, high)), (1, range(high + langid.CONTEXT - 1, low - 1, -1))):
            state = np.zeros(langid.UNITS)
            for i in places:
                state = step(k, state, at(i))
                states[(k, i)] = state
        for i in range(low, min(high, len(data))):
            v = net.output.astype(float) @ np.concatenate([states[(0, i)], states[(1, i)]]) + net.bias[:, 0]
            out.append(np.exp(v - v.max()) / np.exp(v - v.max()).sum())
    return np.array(out)


def test_language(spark, docs, empty):
    out = {(x["doc_id"], x["lang_pred"]): x for x in langid.op4_byte_bigru_language(docs).collect()}
    by = {k[0]: x for k, x in out.items()}
    und = {x["doc_id"] for x in docs.collect() if not any(map(str.isalpha, x["text"] or ""))}
    assert {i for i, x in by.items() if x["lang_pred"] == "und"} == und
    assert all(0 <= x["score"] <= 1 and x["lang_pred"] in ("en", "de", "und") for x in by.values())
    assert all(x["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, x in by.items() if i is not None)
    assert langid.op4_byte_bigru_language(empty).count() == 0
    kept = langid.identified_documents(docs)
    assert kept.columns == docs.columns and kept.where("score = 0.5 or score is null").count() == kept.count()
    # the query and both outputs of the operator against the equations
    net = langid.learned(docs)
    for x in docs.collect():
        if not x["text"] or x["doc_id"] in und or len(x["text"]) > 1000:
            continue
        p = brute_network(net, x["text"].encode())
        mean = p.mean(axis=0)
        assert by[x["doc_id"]]["score"] == pytest.approx(mean.max(), abs=1e-4) and by[x["doc_id"]]["lang_pred"] == net.languages[mean.argmax()]
        sure = np.sort(p, axis=1)[:, -1] - np.sort(p, axis=1)[:, -2] > 1e-3
        labels = [k for a, b, k in langid.position_labels(net, x["text"]) for _ in range(a, b)]
        assert len(labels) == len(p) and all(net.languages[k] == got for k, got, ok in zip(p.argmax(axis=1), labels, sure, strict=True) if ok)
    clash = langid.with_language(docs.select("text", F.lit(1).alias("_r"), F.lit(2).alias("row"), F.lit(3).alias("lang_pred")), net)
    assert clash.columns == ["text", "_r", "row", "lang_pred", "lang_score"] and {(x["_r"], x["row"]) for x in clash.collect()} == {(1, 2)}
    # a text in two languages is labelled in two parts, also far from its start
    r = random.Random(3)
    make = lambda s, n: " ".join("".join(r.choice(s) for _ in range(r.randint(2, 7))) for _ in range(n))
    net = langid.train([(make("abcdefg", 60), "x") for _ in range(60)] + [(make("nopqrst", 60), "y") for _ in range(60)])
    front, back = make("abcdefg", 20_000), make("nopqrst", 300)
    labelled = langid.with_position_labels(spark.createDataFrame([(front + " " + back,), (None,), ("",)], "text string"), net).collect()
    runs = labelled[0]["lang_runs"]
    assert [x["lang_runs"] for x in labelled[1:]] == [[], []] and runs[0]["start"] == 0 and runs[-1]["end"] == len(front) + 1 + len(back)
    right = sum(min(x["end"], len(front)) - x["start"] for x in runs if x["lang"] == "x" and x["start"] < len(front)) + sum(x["end"] - max(x["start"], len(front)) for x in runs if x["lang"] == "y" and x["end"] > len(front))
    assert right > 0.98 * (len(front) + len(back))


def test_language_held_out(spark):
    """Held-out documents of a scale factor are told apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.op4_byte_bigru_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(out) > 200 and np.mean([x["lang"] == x["lang_pred"] for x in out]) > 0.97


def test_bit_packing(spark, docs, empty):
    for bits in (1, 3, 8, 13, 16, 17, 31, 32):
        ids = np.random.default_rng(bits).integers(0, 2**bits, 700, dtype=np.uint64)
        assert (bitpack.unpack(bitpack.pack(ids, bits), 700, bits) == ids).all()
    ids = np.arange(10_000) % 3000
    shard = bitpack.Shard(bitpack.shard_bytes([5, None], [9999, 1], ids, 12))
    assert (shard.read(4000, 8200) == ids[4000:8200]).all() and shard.doc_ids == [5, None] and list(shard.document(1)) == [ids[-1]]
    assert bitpack.width(49408) == 16 and bitpack.width(1) == 1 and bitpack.width(65537) == 17
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bitpack.vocabulary_path())
    rows = sorted(((x["doc_id"], x["text"] or "") for x in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, signed_hash(x[1]), x[1]))
    want, at = [], 0
    for doc_id, text in rows:
        own = [*t.encode(text, add_special_tokens=False).ids, 1]
        want.append((doc_id, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    got = [tuple(x) for x in bitpack.op5_bit_packed_ids(docs).orderBy("start").collect()]
    assert got == want
    assert bitpack.op5_bit_packed_ids(empty).count() == 0
    encoder = bitpack.WordEncoder(bitpack.vocabulary_path())
    for text in ("İstanbul ΑΣ Σ́ é x", "日本　語 1234's'RE  \x1c y\x85z\xa0q \xad-", "ﬁ Å don't I'LL ''s x'y’s", "ǅ ŉ ß ẞ ſ <|startoftext|>"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_fertility(docs, empty):
    out = fertility.op6_tokenizer_fertility(docs).collect()
    texts = {x["doc_id"]: x["text"] or "" for x in docs.collect()}
    assert len(out) == docs.count()
    for x in out:
        text = texts[x["doc_id"]]
        w = words(text)
        runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        held = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if words(line):
                again += line in seen
                seen.add(line)
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(held))
        assert x["base_failed"] == (len(w) < 10 or 100 * len(held) > 20 * len(w)) and not (x["base_failed"] and x["kept"])
    assert sum(x["kept"] for x in out) > 0.8 * sum(not x["base_failed"] for x in out)
    assert fertility.op6_tokenizer_fertility(empty).count() == 0
    assert fertility.op6_tokenizer_fertility(docs.drop("lang")).count() == docs.count()


def brute_verdicts(rows):
    """doc_id -> kept, by the bands' definition, from rows of measures."""
    low_median = lambda v: sorted(v)[-(-len(v) // 2) - 1] if v else None

    def off(x, m, b):
        a, c = fertility.FLOORS[m]
        centre = b["mid"][m] + (b["tilt"][m] * (x["log"] - b["mid"]["log"]) if m in fertility.TILTED else 0)
        return abs(x[m] - centre) / (a + c / np.sqrt(max(1, x["n_tokens"])))

    data = [r.asDict() | {"log": float(np.log2(max(1, r["n_tokens"]))), "bands": (f"{r['script']}|{r['lang'] or ''}", r["script"], "")} for r in rows]
    passing = [x for x in data if not (x["n_words"] < 10 or 100 * x["n_repeat_words"] > 20 * x["n_words"])]
    found = {}
    for name in {b for x in passing for b in x["bands"]}:
        own = list({(x["bands"][0], x["text_hash"]): x for x in passing if name in x["bands"]}.values())
        if name and len(own) < fertility.LEAST_TEXTS:
            continue
        b = {"mid": {m: low_median([x[m] for x in own]) for m in (*fertility.FLOORS, "log")}}
        b["tilt"] = {m: low_median([(x[m] - b["mid"][m]) / (x["log"] - b["mid"]["log"]) for x in own if abs(x["log"] - b["mid"]["log"]) >= 1]) or 0.0 for m in fertility.TILTED}
        offs = {m: sorted(off(x, m, b) for x in own) for m in fertility.FLOORS}
        wide = lambda v: 0.0 if "|" in name else fertility.MIXED_MARGIN * v[int(np.ceil(fertility.MIXED_QUANTILE * len(v))) - 1]  # noqa: E731, B023
        b["half"] = {m: max(1.0, 1.4826 * fertility.BAND * low_median(v), wide(v)) for m, v in offs.items()}
        found[name] = b
    out = {x["doc_id"]: False for x in data}
    for x in passing:
        b = next(found[n] for n in x["bands"] if n in found)
        out[x["doc_id"]] = all(off(x, m, b) <= b["half"][m] for m in fertility.FLOORS)
    return out


def test_fertility_measures_and_verdicts(spark, docs):
    """Measures against the libraries word by word; `kept` against the bands' definition, on a whole table; planted junk goes."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(fertility.VOCABULARIES[0]))
    ranks = {}
    with open(public_tokenizers.path(fertility.VOCABULARIES[1]), "rb") as f:
        for line in f:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    pairs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    for x in fertility.with_measures(docs).collect():
        w = words(texts[x["doc_id"]])
        if not w:
            assert x["chars_per_token"] is None and x["n_tokens"] == 0
            continue
        for k, ids, bare in (("", [i for v in w for i in model.encode(v)], model.is_byte), ("_2", [i for v in w for i in pairs.encode_ordinary(" " + v)], lambda i: b"\xef\xbf\xbd" in pairs.decode_bytes([i]).decode("utf-8", "replace").encode())):
            n = len(ids)
            entropy = -sum(c / n * np.log2(c / n) for c in Counter(ids).values())
            assert x[f"chars_per_token{k}"] == pytest.approx(sum(map(len, w)) / n)
            assert x[f"byte_share{k}"] == pytest.approx(sum(bool(bare(i)) for i in ids) / n)
            assert x[f"evenness{k}"] == pytest.approx(max(0.0, entropy) / np.log2(max(2, min(n, len(ranks) if k else model.get_piece_size()))), abs=1e-9)
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    r = random.Random(21)
    clean = [x["text"] for x in real.where("lang = 'en' and length(text) between 800 and 6000").orderBy("doc_id").limit(40).collect()]
    plant = lambda n, base, out: " ".join([*base.split()[:n], *out])
    noise = lambda n: base64.b64encode(r.randbytes(n)).decode()
    junk = {
        1_000_001: " ".join(noise(45) for _ in range(60)),
        1_000_002: plant(20, clean[0], [noise(60) for _ in range(40)]),
        1_000_003: "".join(chr(r.randint(0x410, 0x44F)) if r.random() < 0.85 else " " for _ in range(2000)),
        1_000_004: " ".join("".join(r.choice("ÃÂ©¨€â™œžÅ") for _ in range(7)) for _ in range(200)),
        1_000_005: " ".join("".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(5)) for _ in range(100)),
    }
    both = real.unionByName(spark.createDataFrame([(i, t, "en") for i, t in junk.items()], "doc_id long, text string, lang string"))
    measured = fertility.with_measures(both).collect()
    kept = {x["doc_id"]: x["kept"] for x in fertility.op6_tokenizer_fertility(both).collect()}
    assert kept == brute_verdicts(measured)
    assert not any(kept[i] for i in junk)
    failed = {x["doc_id"] for x in measured if x["n_words"] < 10 or 100 * x["n_repeat_words"] > 20 * x["n_words"]}
    good = {x["doc_id"] for x in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1").collect()} - failed
    assert sum(kept[i] for i in good) >= 0.95 * len(good)


def brute_units(text):
    out = []
    for run in words(text):
        out += [run] if len(run) <= winnow.UNIT else [run[i : i + winnow.UNIT] for i in range(len(run) - winnow.UNIT + 1)]
    return out


def brute_picks(text, gram=winnow.GRAM, window=winnow.WINDOW):
    """(position, hash) of the selected grams, by the definition."""
    units = [xxhash.xxh64_intdigest(u.encode(), seed=42) for u in brute_units(text)]
    units = [(h - 2**64 if h >= 2**63 else h) % winnow.PRIME for h in units]
    if not units:
        return []
    units += [0] * (gram - len(units))
    hs = [sum(h * winnow.BASE ** (gram - 1 - k) for k, h in enumerate(units[i : i + gram])) % winnow.PRIME for i in range(len(units) - gram + 1)]
    out = []
    for s in range(max(1, len(hs) - window + 1)):
        part = hs[s : s + window]
        k = s + max(i for i, v in enumerate(part) if v == min(part))
        if not out or out[-1][0] < k:
            out.append((k, hs[k]))
    return out


def brute_likeness(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def signed_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - 2**64 if h >= 2**63 else h


def brute_prints(rows):
    """All columns of the query for (doc_id, text) rows."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, signed_hash(x[1]), x[1]))
    out = Counter()
    for k, (i, text) in enumerate(rows):
        cut, after = len(text) // 4, rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - cut] + after[:cut]
        own, changed = brute_picks(text), brute_picks(edited)
        say = lambda p: ",".join(f"{a}:{b:X}" for a, b in p)
        out[(i, len(text), hashlib.sha256(edited.encode()).hexdigest(), say(own), say(changed), round(brute_likeness(own, changed), 9), round(brute_likeness(own, brute_picks(after)), 9), len(own))] += 1
    return out


def printed(df):
    return Counter((x["doc_id"], x["n_chars"], x["edited_sha256"], x["fingerprint"], x["edited_fingerprint"], round(x["near_edited"], 9), round(x["near_next"], 9), x["n_picks"]) for x in df.collect())


def test_winnowing(spark, docs, empty, monkeypatch):
    clash = docs.select("doc_id", "text", F.lit(1).alias("picks"), F.lit(2).alias("_picks_grams"), F.lit(3).alias("fingerprint"))
    df = winnow.with_fingerprint(clash)
    assert df.columns == ["doc_id", "text", "picks", "_picks_grams", "fingerprint"]
    for x in df.collect():
        assert [tuple(p) for p in x["fingerprint"]] == brute_picks(x["text"]) and (x["picks"], x["_picks_grams"]) == (1, 2)
    tied = spark.createDataFrame([(0, "a a a a a a a a a a a")], "doc_id long, text string")
    assert [tuple(p) for p in winnow.with_fingerprint(tied).first()["fingerprint"]] == brute_picks("a a a a a a a a a a a")
    for gram, window in ((1, 2), (3, 5), (5, 4), (8, 3)):
        got = winnow.with_picks(docs.select("text"), "text", "p", gram, window).select("text", F.transform("p", lambda p: F.struct(winnow.gram_position(p), winnow.gram_hash(p))).alias("p"))
        assert all([tuple(p) for p in x["p"]] == brute_picks(x["text"], gram, window) for x in got.collect())
    rows = [(x["doc_id"], x["text"]) for x in docs.collect()]
    assert printed(winnow.op7_winnow_fingerprints(docs)) == brute_prints(rows)
    assert winnow.op7_winnow_fingerprints(empty).count() == 0
    one = docs.where("doc_id = 5")
    assert printed(winnow.op7_winnow_fingerprints(one)) == brute_prints([(x["doc_id"], x["text"]) for x in one.collect()])
    # sparse, negative and repeated ids, many null ids: the same order, dealt out by levels and hashes
    monkeypatch.setattr(winnow, "HOT_ROWS", 20)
    r = random.Random(4)
    rows = [(r.randint(-(2**63), 2**63 - 1), make_text(r, 9)) for _ in range(40)] + [(None, make_text(r, 7)) for _ in range(30)] + [(77, make_text(r, 8)) for _ in range(50)] + [(78, "same text again and again")] * 3
    assert printed(winnow.op7_winnow_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute_prints(rows)


def test_winnowing_guarantee(spark):
    """A passage of GRAM + WINDOW - 1 units, or its code points without spaces, shares a pick wherever it stands; very long texts work."""
    r = random.Random(8)
    passage = "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(400)) + "𠀀" * 2 + "end"
    least = passage[100 : 100 + winnow.UNIT + winnow.GRAM + winnow.WINDOW - 2]
    words7 = make_text(r, winnow.GRAM + winnow.WINDOW - 1)
    long = make_text(r, 60_000)
    rows = [(0, passage), (1, "x" + passage), (2, "two words " + passage[5:]), (3, "甲乙丙" + least + "丁"), (4, words7), (5, f"{make_text(r, 30)} {words7} {make_text(r, 3)}"), (6, long), (7, "x" * 200_000), (8, long + " end")]
    found = {x["doc_id"]: x["fingerprint"] for x in winnow.with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hashes = {i: {p["hash"] for p in f} for i, f in found.items()}
    for i in (1, 2):
        assert len(hashes[0] & hashes[i]) > 0.9 * len(hashes[0] | hashes[i])
    assert hashes[0] & hashes[3] and hashes[4] & hashes[5]
    assert [tuple(p) for p in found[0]] == brute_picks(passage) and [tuple(p) for p in found[6]] == brute_picks(long)
    assert len(hashes[7]) == 1 and len(hashes[6] & hashes[8]) > 0.99 * len(hashes[6])


def brute_forest(forest, row):
    """A row's score, tree by tree and node by node."""
    total = forest.base
    for k in forest.roots:
        while forest.left[k] != k:
            k = forest.left[k] if row[forest.feature[k]] <= forest.threshold[k] else forest.right[k]
        total += forest.value[k]
    return 1 / (1 + np.exp(-total))


def brute_features(text):
    """The statistics by their names."""
    w, data = words(text), (text or "").encode()
    if not w:
        return np.zeros(len(textstats.FEATURES))
    n, lengths, held = len(data), [len(x.encode()) for x in w], Counter(w)
    of = lambda chars: sum(data.count(c.encode()) for c in chars) / n
    lines = [x for x in re.split(r"\n", text) if words(x)]
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    shares = [c / n for c in Counter(data).values()]
    upper, lower = sum(65 <= c <= 90 for c in data), sum(97 <= c <= 122 for c in data)
    capital = sum("A" <= x[0] <= "Z" for x in w)
    return np.array([
        np.log1p(n), np.log1p(len(w)), np.mean(lengths), np.std(lengths), max(lengths), upper / n, of("0123456789"), sum(33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 for c in data) / n, of("#*$%&|<>"), of("!"),
        of(" \t\n\v\f\r"), data.count(b"\n") / len(w), len(held) / len(w), max(held.values()) / len(w), len(repeated) / len(w), (len(lines) - len(set(lines))) / (data.count(b"\n") + 1), sum(c > 127 for c in data) / n, -sum(s * np.log2(s) for s in shares),
        sum(map(data.count, (b".", b"!", b"?"))) / len(w), capital / len(w), sum(c for c in held.values() if c > 1) / len(w), upper / max(1, upper + lower),
    ])


def test_quality_against_brute_force(spark, docs, labels):
    """The query's scores: statistics by their definition, the rows learned from by the contract, the forest walked node by node; held-out rows are told apart."""
    for x in docs.collect():
        assert np.allclose(textstats.features(x["text"]), brute_features(x["text"]), rtol=1e-4, atol=1e-5), x["text"]
    sf = "/root/testdata/sf0.01"
    table, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    truth = {x["doc_id"]: x["quality"] for x in marks.collect()}
    texts = {x["doc_id"]: x["text"] for x in table.collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    chosen = [i for i in texts if i in truth and not held(i)]
    x = np.stack([textstats.features(texts[i]) for i in chosen])
    order = np.lexsort((*x.T[::-1], np.array(chosen)))
    forest = quality.fit(x[order], np.array([truth[i] for i in chosen], float)[order])
    out = {r["doc_id"]: r for r in quality.op8_boosted_quality(table, marks).collect()}
    assert all(out[i]["score"] == pytest.approx(brute_forest(forest, textstats.features(t)), abs=1e-6) and out[i]["held_out"] == held(i) for i, t in texts.items())
    good, bad = ([out[i]["score"] for i in texts if i in truth and held(i) and truth[i] == y] for y in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.95


def test_boosting(docs, empty, labels):
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.fit(x[:2000], y[:2000])
    assert ((forest.scores(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95

    assert np.allclose([brute_forest(forest, v) for v in x[:50]], forest.scores(x[:50]))
    out = quality.op8_boosted_quality(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= v["score"] <= 1 and v["predicted"] == int(v["score"] >= 0.3) for v in out)
    assert quality.op8_boosted_quality(empty, labels).count() == 0
    assert {v["score"] for v in quality.op8_boosted_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.good_documents(docs, labels, 0.0).columns == docs.columns


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[k] for k in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(spark, docs, empty):
    out = mixing.op9_curriculum_mix(docs).collect()
    rows = docs.collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for x in rows:
        sizes[x["source"]] += len(words(x["text"]))
    want = brute_targets(dict(sizes))
    taken = Counter()
    for x in out:
        assert x["target"] == pytest.approx(want[x["source"]]) and x["source_size"] == sizes[x["source"]]
        assert x["taken"] <= 2 * x["size"] and x["taken"] % max(1, x["size"]) == 0
        taken[x["source"]] += x["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 200
    again = {tuple(x) for x in mixing.op9_curriculum_mix(docs.repartition(3)).collect()}
    assert again == {tuple(x) for x in out}
    assert mixing.op9_curriculum_mix(empty).count() == 0
    # a schedule's inverse is monotonic and early schedules come early
    t = [spark.range(1).select(mixing._inverted(F.lit(u), F.array(*map(F.lit, (1.5, 1.0, 0.5))))).first()[0] for u in (0.0, 0.25, 0.5, 0.75, 1.0)]
    assert t == sorted(t) and t[0] == 0 and t[-1] == pytest.approx(1.0) and t[2] < 0.5
    u = t[2]
    assert (1.5 * u - u * u / 2) == pytest.approx(0.5)
    made = mixing.mixed_documents(docs)
    assert made.columns == docs.columns
    order = mixing.curriculum(mixing.mix(docs)).collect()
    assert [x["position"] for x in order] == sorted(x["position"] for x in order)


def test_byte_pair_encoding(docs, empty):
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path()
    t, c = Tokenizer.from_file(path), bpe.codec(path)
    for x in docs.collect():
        ids = t.encode(x["text"] or "", add_special_tokens=False).ids
        assert c.encode(x["text"]) == ids and c.decode(ids) == t.decode(ids, skip_special_tokens=False)
    for ids in ([255, 254], [50256, 1, 200], []):
        assert c.decode(ids) == t.decode(ids, skip_special_tokens=False)
    out = {x["doc_id"]: x for x in bpe.op10_bpe_round_trip(docs).collect()}
    for x in docs.collect():
        ids = t.encode(x["text"] or "", add_special_tokens=False).ids
        assert out[x["doc_id"]]["n_tokens"] == len(ids) and out[x["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert bpe.op10_bpe_round_trip(empty).count() == 0
    back = bpe.with_decoded(bpe.with_token_ids(docs))
    assert back.where("not decoded <=> coalesce(text, '')").count() == 0


def kept_by_brute_force(name, rows, spark, sf):
    """What a stage keeps of (doc_id, text) rows, by each operator's own model applied to one text at a time, or by the definition."""
    docs = spark.createDataFrame([tuple(x) for x in rows], rows[0].__fields__ and spark.read.parquet(f"{sf}/documents.parquet").schema)
    if name == "language":
        net = langid.learned(docs)
        out = []
        for x in rows:
            p = langid.probabilities(net, [x["text"]])[0]
            if any(map(str.isalpha, x["text"] or "")) and p.max() >= langid.LEAST_SCORE:
                out.append(tuple(x))
        return Counter(out)
    if name == "quality":
        forest = quality.learned(docs, spark.read.parquet(f"{sf}/labels.parquet"))
        return Counter(tuple(x) for x in rows if brute_forest(forest, textstats.features(x["text"])) >= quality.GOOD)
    if name == "near_duplicates":
        _, roots = brute_components([(x["doc_id"], x["text"]) for x in rows])
        return Counter(tuple(x) for x in rows if roots[x["doc_id"]] == x["doc_id"])
    if name == "mix":
        taken = {x["doc_id"]: x["times"] for x in mixing.mix(docs).collect()}
        sizes, used = Counter(), Counter()
        for x in rows:
            sizes[x["source"]] += len(words(x["text"]))
            used[x["source"]] += taken[x["doc_id"]] * len(words(x["text"]))
        want = brute_targets(dict(sizes))
        most = max(len(words(x["text"])) for x in rows)
        assert all(abs(used[s] - want[s]) <= most for s in sizes)
        return Counter({tuple(x): taken[x["doc_id"]] for x in rows if taken[x["doc_id"]]})
    raise KeyError(name)


def test_pipeline(spark):
    """Every stage on all that its predecessor kept, against brute force; run() gives what the stages give."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = docs.collect()
        out = common.saved(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == docs.columns
        assert Counter(tuple(x) for x in out.collect()) == kept_by_brute_force(name, rows, spark, sf), name
        docs = out
    name, stage = corpus_pipeline.STAGES[-1]
    t = Tokenizer.from_file(bpe.vocabulary_path())
    want = Counter()
    for x in docs.collect():
        ids = t.encode(x["text"] or "", add_special_tokens=False).ids
        want[(x["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    last = stage(spark, docs, sf)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and Counter(tuple(x) for x in last.collect()) == want
    assert Counter(tuple(x) for x in corpus_pipeline.run(spark, sf).collect()) == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mix", "tokens"]


def test_pipeline_stages_on_odd_tables(spark):
    """Empty tables, nulls in every column, ties, repeated ids and rows, very long texts and clashing names: no stage crashes, and each has its defined result."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    good = [x["text"] for x in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) > 1500 and lang = 'en'").orderBy("doc_id").limit(12).collect()]
    rows = [(i, t, "en", f"s{i % 2}", len(t), "r", 1.0) for i, t in enumerate(good)]
    rows += [(5, good[0], "en", "s1", 1, "r", 1.0), rows[3], rows[3], (None, None, None, None, None, None, None), (None, good[1], None, None, None, "r", None), (40, "", "en", "s0", 0, "r", 1.0), (41, " \n\t", "en", "s0", 3, "r", 1.0)]
    rows += [(42, (good[2] + " ") * 300, "en", "s0", 9, "r", 1.0), (43, "x" * 300_000, "en", "s0", 9, "r", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, score double").repartition(3)
    none = docs.where("doc_id < -1")
    given = Counter(map(tuple, rows))
    for name, stage in corpus_pipeline.STAGES:
        out, blank = stage(spark, docs, sf), stage(spark, none, sf)
        assert blank.count() == 0 and blank.columns == out.columns
        got = Counter(tuple(x) for x in out.collect())
        if name == "tokens":
            assert sum(got.values()) == len(rows)
            continue
        assert out.columns == docs.columns and set(got) <= set(given)
        if name in ("language", "quality"):
            # every row by itself: copies go or stay together
            assert all(n == given[x] for x, n in got.items())
        if name == "language":
            assert not any(x[1] is None or not any(map(str.isalpha, x[1])) for x in got)
        if name == "near_duplicates":
            assert got[rows[3]] == 1 and sum(n for x, n in got.items() if x[0] is None) == 2
            # document 5's other text is a copy of document 0's, which stays
            assert got[rows[0]] == 1 and not got[(5, good[0], "en", "s1", 1, "r", 1.0)] and got[rows[5]] == 1
        if name == "mix":
            assert not any(not words(x[1]) for x in got) and all(n <= 2 * given[x] for x, n in got.items())
            planned = Counter()
            for x in mixing.mix(docs).collect():
                planned[(x["doc_id"], x["source"], x["size"], x["text_hash"])] += x["times"]
            made = Counter()
            for x, n in got.items():
                made[(x[0], x[3], len(words(x[1])), signed_hash(x[1]))] += n
            assert made == +planned


def test_fertility_bands(spark):
    """Gibberish goes wherever its length, language and script put it; texts of rare languages are judged by their script."""
    r = random.Random(9)
    noise = lambda n: " ".join("".join(r.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(r.randint(4, 9))) for _ in range(n))
    rows = [(i, make_text(r, r.randint(20, 400)), ("en", "de")[i % 2]) for i in range(160)] + [(i, make_text(r, 150), "rare") for i in (200, 201)]
    junk = [(300, noise(200), "en"), (301, noise(20_000), "en"), (302, noise(20_000), "de"), (303, noise(100), "rarer"), (304, noise(100), None), (305, "ѣ" * 9 + " " + " ".join("".join(chr(r.randint(0x460, 0x52F)) for _ in range(8)) for _ in range(60)), "zz")]
    out = {x["doc_id"]: x for x in fertility.op6_tokenizer_fertility(spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")).collect()}
    assert not any(out[i]["base_failed"] for i, _, _ in junk) and not [i for i, _, _ in junk if out[i]["kept"]]
    assert sum(out[i]["kept"] for i, _, _ in rows) >= 0.95 * len(rows) and out[200]["kept"] and out[201]["kept"]
    # copies of one text make no band
    copies = spark.createDataFrame(rows + [(400 + i, junk[3][1], "zz") for i in range(60)], "doc_id long, text string, lang string")
    assert not any(x["kept"] for x in fertility.op6_tokenizer_fertility(copies).where("doc_id >= 400").collect())


def test_rare_languages_are_learned(spark):
    """A language is learned from and predicted, however rare it is and however many others there are."""
    r = random.Random(6)
    make = lambda s: " ".join("".join(r.choice(s) for _ in range(r.randint(2, 7))) for _ in range(40))
    rows = [(i, make("abcdefg"), "many") for i in range(3000)] + [(5000 + i, make("éèêlmno"), "rare") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).cache()
    got = Counter(x["lang"] for x in langid.chosen(docs, 200).collect())
    kept = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % langid.FOLDS != langid.HELD_OUT]
    assert got == {"many": 100, "rare": sum(i >= 5000 for i in kept)}
    out = langid.with_language(docs.where("doc_id >= 5000"), langid.learned(docs, 200)).collect()
    assert {x["lang_pred"] for x in out} == {"rare"}
    # copies of a document stay within the bound
    copies = docs.where("lang = 'rare'").withColumn("doc_id", F.lit(5000).cast("long")).withColumn("text", F.lit("a b")).crossJoin(spark.range(9).select()).unionByName(docs)
    assert max(Counter(x["lang"] for x in langid.chosen(copies, 60).collect()).values()) == 30
    net = langid.train([(chr(0x4E00 + k) * 9, f"l{k:02}") for k in range(70)], updates=1)
    assert len(net.languages) == 70 and langid.probabilities(net, ["x"]).shape == (1, 70)


def test_toxic_versions_of_clean_texts_are_learned():
    """A toxic text made of a clean one is no copy of it; texts that share a passage are counted; copies with one label once."""
    r = random.Random(12)
    clean = [make_text(r, 80) for _ in range(120)]
    rows = [x for t in clean for x in ((t, 0), (t + " you vile vile scum", 1))]
    assert {b"vile", b"scum"} <= set(toxicity.train(rows).weights)
    shared = make_text(r, 60)
    seen = toxicity.Seen()
    assert all(seen.add(toxicity.tokens(f"{t} {shared}")) for t in clean)
    near = [t.split() for t in clean]
    assert not any(seen.add(toxicity.tokens(" ".join([*t, shared]))) for t in near)
    for t in near:
        t[40] = "changed"
    assert sum(seen.add(toxicity.tokens(" ".join([*t, shared]))) for t in near) < 10
    once = toxicity.train([(t, 0) for t in clean] + [("rareword " * 3 + clean[0], 1)] * 50)
    assert b"rareword" not in once.weights


def test_near_duplicates_of_repeated_ids(spark):
    """A doc_id with different texts: each text finds its own copies, and none goes without one."""
    r = random.Random(14)
    texts = [make_text(r, 120) for _ in range(24)]

    def near(t):
        w = t.split()
        w[60] = "changed"
        return " ".join(w)

    rows = [(5, t) for t in texts] + [(100 + i, near(t)) for i, t in enumerate(texts)] + [(3, near(texts[0]) + " end"), (5, texts[1]), (5, near(texts[2]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = Counter((x["doc_id"], x["component_id"], x["kept"]) for x in neardup.op3_near_duplicates(docs).collect())
    # text 0 is a copy of document 3's, all others under id 5 are originals
    want = Counter({(3, 3, True): 1, (5, 3, False): 1, (100, 3, False): 1, (5, 5, True): 25})
    assert out == want + Counter({(100 + i, 5, False): 1 for i in range(1, 24)})
    kept = Counter((x["doc_id"], x["text"]) for x in neardup.without_near_duplicates(docs).collect())
    assert len(kept) == 24 and set(kept.values()) == {1} and kept[(3, near(texts[0]) + " end")] == 1
    assert all(kept[(5, t)] for t in (texts[1], *texts[3:])) and kept[(5, texts[2])] + kept[(5, near(texts[2]))] == 1


def test_queries_on_odd_tables(spark, labels):
    """Very long texts, unlike texts under one id, copies, nulls in every column, an empty table and clashing names, through every query."""
    from tokenizers import Tokenizer

    r = random.Random(31)
    long, unspaced = make_text(r, 30_000), "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(8_000))
    rows = [(1, long), (2, unspaced), (3, long + " end"), (3, make_text(r, 60)), (3, make_text(r, 80)), (4, "same"), (4, "same"), (None, None), (None, "text without an id, of more than five words"), (5, ""), (6, "\n \t"), (7, "x" * 100_000), (8, "<|endoftext|> <|startoftext|>"), (9, "word\n" * 10_000)]
    rows += [(20 + i, make_text(r, 30)) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else None, "s" if i else None) for i, t in rows], "doc_id long, text string, lang string, source string")
    for name in ("h", "block", "part", "guest", "picks", "row", "found", "size", "slice", "key", "id", "cell", "start", "index", "score"):
        docs = docs.withColumn(name, F.lit(None).cast("string"))
    docs, empty = docs.repartition(4).cache(), docs.where("doc_id < -1")
    given = Counter(i for i, _ in rows)
    runs = {
        "op2": lambda d: toxicity.op2_toxic_segments(d, labels), "op3": neardup.op3_near_duplicates, "op4": langid.op4_byte_bigru_language, "op5": bitpack.op5_bit_packed_ids, "op6": fertility.op6_tokenizer_fertility,
        "op7": winnow.op7_winnow_fingerprints, "op8": lambda d: quality.op8_boosted_quality(d, labels), "op9": mixing.op9_curriculum_mix, "op10": bpe.op10_bpe_round_trip,
    }
    got = {}
    for name, run in runs.items():
        got[name] = run(docs).collect()
        assert Counter(x["doc_id"] for x in got[name]) == given, name
        assert run(empty).count() == 0, name
    by = lambda name, i: sorted((x for x in got[name] if x["doc_id"] == i), key=str)
    assert len({x["score"] for x in by("op2", 4)}) == 1 and {x["score"] for x in by("op2", 5)} == {0.0}
    assert by("op3", 1)[0]["n_shingles"] == len({tuple(long.split()[i : i + 5]) for i in range(30_000 - 4)}) and [x["component_id"] for x in by("op3", 3)].count(1) == 1
    assert by("op3", 9)[0]["n_shingles"] == 1 and all(x["component_id"] is None and x["kept"] for x in by("op3", None))
    assert {x["lang_pred"] for i in (5, 6) for x in by("op4", i)} == {"und"} and by("op4", 2)[0]["lang_pred"] != "und"
    # byte-pair merges of a run of one letter take the library quadratic time, so it sees a shorter one
    t, c = Tokenizer.from_file(bitpack.vocabulary_path()), Tokenizer.from_file(bpe.vocabulary_path())
    sizes = {}
    for i, text in rows:
        if text is None or len(text) < 90_000 or i in (1, 3):
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
            assert any(x["n_tokens"] == len(ids) and x["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) for x in by("op5", i)), i
            ids = c.encode(text or "", add_special_tokens=False).ids
            assert any(x["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for x in by("op10", i)), i
        sizes.setdefault(i, []).append(len(words(text)))
    ends = sorted((x["start"], x["n_tokens"]) for x in got["op5"])
    assert all(a + n == b for (a, n), (b, _) in zip(ends[:-1], ends[1:], strict=True)) and ends[0][0] == 0
    assert by("op6", 9)[0]["base_failed"] and by("op6", 1)[0]["n_words"] == 30_000 and not by("op6", None)[0]["kept"]
    assert printed(winnow.op7_winnow_fingerprints(docs)) == brute_prints(rows)
    assert all(sorted(x["size"] for x in by("op9", i)) == sorted(n) and all(x["taken"] <= 2 * x["size"] for x in by("op9", i)) for i, n in sizes.items())
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "u", long, "x"), (2, "u", long, "x"), (None, "v", "é" * 100_000, None)], "page_id long, url string, html string, digest string")
    assert fixity.op1_merkle_audit(pages).count() == 0 and fixity.audit(fixity.layout(pages), fixity.layout(pages.where("page_id = 2").limit(1))).count() == 3
