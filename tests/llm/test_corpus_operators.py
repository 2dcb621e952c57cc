"""Each corpus operator against brute force, and its defined results for nulls, empty and long texts, repeats and
clashing columns."""

import base64
import bisect
import gzip
import hashlib
import io
import itertools
import random
import re
import struct
import time
import wave
import zipfile
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tamis.llm import common, decontaminate, html_text, media, packing, pii, quality, shards, simhash, tokens, toxicity, warc

EXTRA = "doc_id long, text string, score double, fingerprint string, `n_email` int, `odd name` string"
LONG = "word and more, " * 40_000


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "an idiot wrote this"), (4, LONG), (5, "same text here"), (5, "same text here"), (6, "same text here"), (7, "ÄÖ 漢字 \U0001f600 x")]
    return spark.createDataFrame([(i, t, 1.0, "f", 3, "o") for i, t in rows], EXTRA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EXTRA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return common.table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return common.table(spark, sf_dir, "labels")


def test_components_against_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2060)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


# 1 ----------------------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.1", "documents"), common.table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.classify(docs, labels).join(labels, "doc_id").toPandas()
    crc = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (got.held_out == crc).all()
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.94
    assert held[held.toxic == 1].predicted.mean() > 0.7 and held[held.toxic == 0].predicted.mean() < 0.04


def test_toxicity_never_learns_held_out_rows(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.training_rows(docs, x) for x in (labels, flipped))
    assert a[0] == b[0] and (a[1] == b[1]).all()


def test_toxicity_trains_on_whole_texts(spark):
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5][:2]
    long_text = " ".join(f"w{k}" for k in range(20_000))
    docs = spark.createDataFrame([(ids[0], long_text), (ids[1], "One word, and ONE more")], "doc_id long, text string")
    rows, y, vocab = toxicity.training_rows(docs, spark.createDataFrame([(ids[0], 1), (ids[1], 0)], "doc_id long, toxic int"))
    assert [" ".join(vocab[w] for w in r) for r in rows] == [long_text, "one word and one more"] and y.tolist() == [1, 0]


def test_long_words_have_all_their_ngrams():
    a, b = "x" * 30 + "idiot" + "x" * 30, "x" * 65
    assert set(toxicity.bucket_ids("idiot")[2:4]) <= set(toxicity.bucket_ids(a)) and set(toxicity.bucket_ids(a)[1:]) != set(toxicity.bucket_ids(b)[1:])


def test_toxicity_odd_rows(spark, odd, none, docs, labels):
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(odd, model).collect()
    assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    empty = [r["score"] for r in got if r["doc_id"] in (1, 2, 3)]
    assert len(set(empty)) == 1
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.classify(odd, no_labels).collect()
    assert len(rows) == 9 and all(r["predicted"] == 0 for r in rows)
    assert next(r for r in rows if r["doc_id"] is None)["held_out"] is False
    assert toxicity.classify(none, no_labels).count() == 0
    one = spark.createDataFrame([(5, 1), (None, 0)], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.classify(odd, one).collect()} <= {0, 1}
    assert toxicity.drop_toxic(odd, no_labels).columns == odd.columns


def test_misspellings_share_vectors():
    rows = [["you", "are", "an", "idiot", "today"], ["you", "are", "kind", "today"], ["what", "an", "idiot"], ["what", "a", "day"]] * 20
    model = toxicity.Model().fit(rows, np.array([1, 0, 1, 0] * 20))
    s = toxicity.Scorer(model.shrunk(), float(model.bias[1] - model.bias[0]))
    assert s.score("an idiott said so") > s.score("an elephant said so")


def test_collapsed_scorer_equals_the_softmax():
    rng = np.random.default_rng(3)
    pool = [f"{a}{b}" for a in ("ab", "cde", "fghi") for b in range(40)]
    rows = [[pool[i] for i in rng.integers(0, len(pool), rng.integers(1, 48))] for _ in range(60)]
    y = np.array([int("ab1" in r or "ab2" in r or k % 9 == 0) for k, r in enumerate(rows)])
    model = toxicity.Model().fit(rows, y)
    scorer = toxicity.Scorer(model.shrunk(), float(model.bias[1] - model.bias[0]))
    for r in rows:
        vectors = [np.mean([model.emb[b] * model.scale[b] for b in toxicity.bucket_ids(w)], axis=0) for w in set(r)]
        logits = np.sum(vectors, axis=0) / toxicity.WINDOW @ model.out + model.bias
        want = np.exp(logits[1]) / np.exp(logits).sum()
        assert len(r) > 24 or abs(scorer.score(" ".join(r)) - want) < 1e-5


def test_toxicity_string_ids(spark):
    docs = spark.createDataFrame([(f"d{k}", "you idiot" if k % 2 else "kind words") for k in range(40)], "doc_id string, text string")
    labels = docs.selectExpr("doc_id", "int(text = 'you idiot') AS toxic")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == 40 and {r["predicted"] for r in got} == {0, 1}


# 2 ----------------------------------------------------------------------------------------------------------------


def test_audio_offsets_and_copies(spark):
    rng = np.random.default_rng(4)
    tunes = rng.normal(0, 0.13, (6, 64))  # ties: two clean copies of each tune
    rows = [(100 * k, media.render(t, 0)) for k, t in enumerate(tunes)]
    rows += [(100 * k + 1, media.render(t, 4)) for k, t in enumerate(tunes)] + [(100 * k + 2, media.render(t, 0)) for k, t in enumerate(tunes)]
    rows += [(7, None), (8, b"no audio"), (None, None)]
    df = spark.createDataFrame([(i, None if a is None else bytearray(a), "x") for i, a in rows], "id long, audio binary, fp string")
    got = {r["id"]: r for r in media.search(df, "id").collect()}
    assert len(got) == len(rows)
    for k in range(6):
        assert got[100 * k]["is_query"] and got[100 * k + 2]["class_id"] == 100 * k
        late = got[100 * k + 1]
        assert (late["best_query"], late["best_offset"]) == (100 * k, -4) and late["best_errors"] < 0.05
    assert got[7]["class_id"] == got[8]["class_id"] == 7 and got[7]["n_links"] == 0
    assert media.search(df.where("false"), "id").count() == 0


def test_audio_search_recall_against_every_offset(spark):
    """Noisy copies begun late, against bit errors at all offsets of all pairs."""
    rng = np.random.default_rng(8)
    fps = {}
    for k in range(40):
        base = rng.integers(0, 1 << 32, 20 + k, dtype=np.uint64).astype("<u4")
        fps[100 * k] = base
        for c, rate in enumerate((0.1, 0.15, 0.17, 0.19, 0.24)):
            flips = np.packbits(rng.random((len(base), 32)) < rate, axis=1).view("<u4").ravel()
            fps[100 * k + 1 + c] = (base ^ flips)[2 * c :]
    fps[9000] = np.concatenate([fps[0][:11], rng.integers(0, 1 << 32, 9, dtype=np.uint64).astype("<u4")])  # the shortest overlaps
    fps[9001] = np.full(400, 77, "<u4")  # a run of one integer
    fps[9100] = np.full(300, 77, "<u4")
    df = spark.createDataFrame([(i, bytearray(f.tobytes())) for i, f in fps.items()], "id long, fp binary")
    got = {r["id"]: r for r in media.align(df, F.col("id") % 100 == 0).collect()}
    links, found = 0, 0
    for i, a in fps.items():
        best = {}
        for q in (q for q in fps if q % 100 == 0):
            at = [(e, -n, q, abs(o), o) for o in range(10 - len(fps[q]), len(a) - 9) for n, e in [media.bit_errors(a, fps[q], o)] if n >= media.LEAST_OVERLAP and e <= media.MOST_ERRORS]
            best |= {q: min(at)} if at else {}
        links, found = links + len(best), found + got[i]["n_links"]
        assert got[i]["n_links"] <= len(best)
        if got[i]["n_links"] == len(best):
            other = min((v for q, v in best.items() if q != i), default=None)
            assert got[i]["best_query"] == (other[2] if other else None)
    assert links > 180 and found >= 0.95 * links
    assert got[9001]["best_query"] == 9100


def test_audio_at_other_rates_and_widths():
    tune = np.random.default_rng(3).normal(0, 0.13, 64)
    clean, rate = media.decode_wav(media.render(tune, 0))
    for to in (16_000, 11_025, 44_100):
        again = media.resampled(clean, rate, to)
        n, errors = media.bit_errors(media.fingerprint(clean, rate), media.fingerprint(again, to), 0)
        assert n > 40 and errors < 0.1, to
    for width in (1, 3, 4):
        out = io.BytesIO()
        with wave.open(out, "wb") as file:
            file.setnchannels(2)
            file.setsampwidth(width)
            file.setframerate(rate)
            ints = np.round(clean / 256 + 128).astype("u1") if width == 1 else (clean * 256.0 ** (width - 2)).astype("<i4")
            raw = ints.repeat(2)
            file.writeframes(raw.tobytes() if width != 3 else raw.view("u1").reshape(-1, 4)[:, :3].tobytes())
        got, same = media.decode_wav(out.getvalue())
        assert same == rate and np.abs(got - clean).max() < (130 if width == 1 else 1)


def test_audio_renders_every_note():
    v = np.random.default_rng(9).normal(0, 0.13, 64)
    w = v.copy()
    w[62] += 0.1
    assert len(media.decode_wav(media.render(v, 0))[0]) == 32 * 2 * media.HOP and media.render(v, 0) != media.render(w, 0)


def test_audio_noise():
    t = np.random.default_rng(5).normal(0, 0.13, 64)
    clean, rate = media.decode_wav(media.render(t, 0))
    noisy = clean + np.random.default_rng(6).normal(0, 300, len(clean))
    n, errors = media.bit_errors(media.fingerprint(clean, rate), media.fingerprint(noisy, rate), 0)
    assert n > 20 and errors < media.MOST_ERRORS


# 3 ----------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/ b", "<p>x</p>"), (1, "http://c", "<p>x</p>"), (1, "http://c", "<p>x</p>"), (2, None, None), (-5, "u", ""), (None, "n", "<p>x</p>"), (9, "é", "ü" * 100_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, sha string")
    listed = warc.write_packages(df, f"file://{tmp_path}/w")
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_packages(listed).collect()), key=str)

    def digest(h):
        return base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()

    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        new = first[h or ""] == i
        want.append((i, len((h or "").encode()), digest(h), "response" if new else "revisit", None if new else first[h or ""]))
    assert got == sorted(want, key=str)
    for r in listed.collect():
        with zipfile.ZipFile(r["path"].removeprefix("file://")) as z:
            assert z.testzip() is None and set(z.namelist()) == {warc.DATA, warc.INDEX}
    assert warc.round_trip(df.where("false")).count() == 0


def test_zip64_and_foreign_packages(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", allowZip64=True) as z:
        z.writestr("other.txt", b"x" * 100, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("stored.bin"), "w", force_zip64=True) as f:
            f.write(b"payload")
        z.comment = b"a comment"
    with open(tmp_path / "a.zip", "rb") as f:
        p = warc.Package(f, (tmp_path / "a.zip").stat().st_size)
        start, size = p.members["stored.bin"]
        assert p.read(start, size) == b"payload" and "other.txt" not in p.members


def test_packages_of_other_makers(tmp_path):
    """Several archives and indexes under other names, one not compressed; a package that is cut short."""
    bodies = {"archive/b.warc.gz": [b"first", b"second"], "archive/a.warc": [b"third" * 1000]}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for n, (name, parts) in enumerate(bodies.items()):
            data, lines = b"", []
            for part in parts:
                packed = gzip.compress(part) if name.endswith("gz") else part
                lines.append(f'com,x)/ 2024 {{"offset": "{len(data)}", "length": "{len(packed)}", "filename": "{name[8:]}"}}'.encode())
                data += packed
            z.writestr(name, data)
            z.writestr(f"indexes/{n}.cdxj", b"!meta\n" + b"\n".join(reversed(lines)))
    whole = (tmp_path / "a.zip").read_bytes()
    package = warc.Package(io.BytesIO(whole), len(whole))
    assert [(e["filename"], r) for e, r in package.records()] == [("a.warc", b"third" * 1000), ("b.warc.gz", b"first"), ("b.warc.gz", b"second")]
    package.file = io.BytesIO(whole[:60])
    with pytest.raises(ValueError):
        list(package.records())


# 4 ----------------------------------------------------------------------------------------------------------------


def test_html_articles_whole(spark, sf_dir):
    from html import unescape

    pages = common.table(spark, sf_dir, "pages")
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_html_noise_and_odd_pages(spark):
    page = """<html><body><header><h1>Site</h1></header><div class="sidebar"><p>Side, text, here.</p></div><div id=content><div class="post">
    <h2>Title &amp; more</h2><p>Hello, world &eacute; this is a long, long paragraph with text.<p>Second one,   too.<br>Line<ul><li>a<li>b</ul></div>
    <div class="comments"><p>me, too, I agree, yes</p></div><form>x<p>Name, please, now</p></form></div><script>if (a < b) "<p>no, no, no</p>"</script>
    <div class="cookie-notice">We use, many, cookies</div><footer>end</footer></body>"""
    assert html_text.main_text(page) == "Title & more\nHello, world é this is a long, long paragraph with text.\nSecond one, too. Line\na\nb"
    df = spark.createDataFrame([(1, "u", None, "t"), (None, None, "", "t"), (2, "u", "<p>" + "<b>" * 30_000 + "x", "t"), (3, "u", "a < b <", "t"), (3, "u", "a < b <", "t")], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in html_text.extract(df).collect()]
    assert sorted(got, key=str) == sorted([(1, ""), (None, ""), (2, "x"), (3, "a < b <"), (3, "a < b <")], key=str)
    assert html_text.extract(df.where("false")).count() == 0


ARTICLE = "".join(f"<p>Paragraph {k}, with commas, words, and more text that fills a line of the page.</p>" for k in range(4))
PARTS = [f"Paragraph {k}, with commas, words, and more text that fills a line of the page." for k in range(4)]


@pytest.mark.parametrize(
    "body, want",
    [
        (f'<div class="wrap has-sidebar"><h1>Head</h1>{ARTICLE}</div><div><p>Other, text.</p></div>', ["Head", *PARTS]),
        (f'<article><div class="entry-header"><h1>Head</h1></div><div><div class="body">{ARTICLE}</div></div></article>', ["Head", *PARTS]),
        (f'<div class="post"><header><h1>Head</h1></header><div class="text">{ARTICLE}</div></div>', ["Head", *PARTS]),
        (f'<div id="x"><h3>Part</h3><p>Short.</p><div>{ARTICLE}</div><ul><li>one<li>two</ul><p>End.</p><ul><li><a href="/a">link</a></ul></div>', ["Part", "Short.", *PARTS, "one", "two", "End."]),
        (f"<form>{ARTICLE}</form><footer>end</footer>", PARTS),
        (f'<div class="newsletter-page">{ARTICLE}</div>', PARTS),
        (f'<div class="comments">{ARTICLE * 3}</div><div class="story"><h2>Head</h2><p>The story, told, shortly.</p></div>', ["Head", "The story, told, shortly."]),
        (f'<div class="ad-free"><div class="left-sidebar"><p>Side, text.</p></div>{ARTICLE}</div>', PARTS),
        (f'<div class="content-sidebar-wrap comment-enabled"><div class="top-ad-box"><p>Buy, now, this.</p></div>{ARTICLE}<div class="page-footer"><p>Foot, note.</p></div></div>', PARTS),
        (f'<div>{ARTICLE}</div><div class="reader-comments-list"><p>I, too, agree.</p></div><p class="site-notice">We, too.</p>', PARTS),
        (f'<div class="breadcrumbs">a, b, c</div><div>{ARTICLE}</div><div class="related-posts"><p>See, this, too.</p></div>', PARTS),
    ],
)
def test_html_pages_of_other_makes(body, want):
    assert html_text.main_text(f"<html><head><title>t</title></head><body>{body}</body></html>").split("\n") == want


def plain_points(root):
    """The points of each element, from the definition: paragraph by paragraph, ancestor by ancestor."""

    def flat(node, blocks):
        return "".join(x if isinstance(x, str) else flat(x, blocks) if blocks or x.tag not in html_text.BLOCK else "" for x in node.inside)

    def letters(text):
        return sum(c not in " \n" for c in text)

    def linked(node):
        return letters(flat(node, True)) if node.tag == "a" else sum(linked(x) for x in node.inside if not isinstance(x, str))

    def every(node):
        return [node, *(y for x in node.inside if not isinstance(x, str) for y in every(x))]

    points = {id(x): 0.0 for x in every(root)}
    share = {id(x): 1 - linked(x) / max(letters(flat(x, True)), 1) for x in every(root)}
    for x in every(root):
        own = flat(x, False)
        if x.tag in html_text.BLOCK and x.tag not in html_text.KEPT and letters(own) >= 2:
            gain = ((1 if x.tag == "p" else 0.5) + own.count(",") + min(letters(own) / 100, 5)) * share[id(x)]
            up = x.above
            for part in (1, 0.5, 0.25, 0.125):
                if up is not None:
                    points[id(up)] += gain * part
                    up = up.above
    return {id(x): points[id(x)] * share[id(x)] * (1.5 if x.tag in ("article", "main") else 1) for x in every(root)}


def test_html_scores_against_the_definition():
    rng = random.Random(4)

    def element(depth):
        tag = rng.choice(["div", "section", "p", "a", "span", "ul", "blockquote", "article", "main", "h2"] if depth else ["div"])
        inside = "".join(rng.choice(["some words, here ", "x", " and, more, commas ", ""]) if depth > 4 or rng.random() < 0.5 else element(depth + 1) for _ in range(rng.randint(1, 4)))
        return f"<{tag}>{inside}</{tag}>"

    for _ in range(150):
        root = html_text.parse(f"<html><body>{element(0)}{element(0)}</body></html>")
        nodes = html_text._walk(root)
        html_text.measure(nodes)
        want = plain_points(root)
        assert all(abs(x.points - want[id(x)]) < 1e-9 for x in nodes)
        inner = nodes[1:]
        top = max(want[id(x)] for x in inner)
        got = html_text.chosen(nodes)
        winner = next(x for x in inner if want[id(x)] >= top - 1e-12)
        if top > 0:
            holders = []
            while winner is not None:
                holders.append(winner)
                winner = winner.above
            assert any(x in holders for x in got)


def test_html_unmatched_tags_take_linear_time():
    began = time.process_time()
    for page in ("<b>" * 150_000 + "</i>" * 150_000 + "x", "<p>" * 200_000 + "x", "<ul><li>" * 60_000 + "x", "<td>" * 100_000 + "</tr>" * 100_000 + "x", "<b><p>" * 100_000 + "x"):
        assert html_text.main_text(page) == "x"
    assert time.process_time() - began < 60


# 5 ----------------------------------------------------------------------------------------------------------------


def plain_pii(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii_patterns(spark, docs, odd, none):
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for r in docs.collect():
        base = plain_pii(r["text"])
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert set(pii.joined(base).split(",")) - {""} <= set(row["spans"].split(","))
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("a.@-+ 0123456789()é\n") for _ in range(rng.randint(0, 40)))
        assert plain_pii(t) == pii.base_spans(t), t
    assert pii.find(odd).count() == 9 and pii.find(none).count() == 0
    assert len(pii.base_spans("a" * 300_000)) == 0 and len(pii.base_spans("1." * 100_000)) > 1000


def test_pii_field_and_redaction(spark):
    t = "Please ask Mr. John Smith about it, or call (555) 123-4567 now. password=7602ad27cf5550de1c ok, mail a.b@c.example.org"
    assert [(k, t[a:b]) for k, a, b in pii.all_spans([t])[0][1]] == [("name", "John Smith"), ("tel", "(555) 123-4567"), ("secret", "7602ad27cf5550de1c"), ("email", "a.b@c.example.org")]
    df = spark.createDataFrame([(1, t, 5), (2, None, 6)], "doc_id long, text string, n_chars int")
    rows = {r["doc_id"]: r for r in pii.redact(df).collect()}
    assert rows[1]["text"].endswith("password=<SECRET> ok, mail <EMAIL>") and rows[1]["n_chars"] == len(rows[1]["text"])
    assert rows[2]["text"] is None and rows[2]["n_chars"] == 6


def plain_viterbi(model, x):
    """The recursion word by word over a whole row."""
    if not len(x):
        return []
    e, trans = model.emissions(np.array(x)), model.t + model.ban
    best, back = e[0] + model.start, []
    for row in e[1:]:
        offer = best[:, None] + trans
        back.append(offer.argmax(0))
        best = offer.max(0) + row
    path = [int(best.argmax())]
    for pick in reversed(back):
        path.append(int(pick[path[-1]]))
    return path[::-1]


def test_field_fits_its_table_and_scores_every_word(docs):
    model, table = pii.field(), pii._training_table()
    rows = [np.array([model.ids[pii.shape(w)] for w in words]) for words, _ in table]
    assert [[pii.STATES[s] for s in g] for g in model.decode(rows)] == [y for _, y in table]
    look = pii.Shapes(model.ids).__getitem__
    some = [np.array([look(w) for w in (r["text"] or "").split()], np.int64) for r in docs.limit(60).collect()]
    rng = np.random.default_rng(12)
    some += [rng.integers(0, model.n, n) for n in (0, 1, 2, 3, 50, 700, 3000)]  # every shape anywhere
    some += [np.full(500, model.ids["title"]), np.tile([model.ids["title"], model.ids["Xx"]], 400)]
    assert [g.tolist() for g in model.decode(some)] == [plain_viterbi(model, x) for x in some]


def test_viterbi_against_enumeration_and_gradient_against_differences():
    model = pii.Field([(w, y) for w, y in pii._training_table()][:40], steps=3)
    rng = np.random.default_rng(2)
    states = range(len(pii.STATES))
    for n in (1, 2, 3):
        x = rng.integers(0, model.n, n)
        e, trans = model.emissions(x), model.t + model.ban

        def total(path, e=e, trans=trans):
            return model.start[path[0]] + sum(e[i, s] for i, s in enumerate(path)) + sum(trans[p, q] for p, q in zip(path, path[1:], strict=False))

        scores = {path: total(path) for path in itertools.product(states, repeat=n)}
        assert model.decode([x])[0].tolist() == list(max(scores, key=scores.get))
        y = np.array([[0] * n])
        said, dw, dt = model.gradient(x[None], y, np.ones((1, n), bool))
        assert abs(said - (scores[(0,) * n] - np.logaddexp.reduce(list(scores.values())))) < 1e-8
        for grad, weights in ((dw, model.w), (dt, model.t)):
            for _ in range(6):
                at = tuple(rng.integers(0, d) for d in weights.shape) if grad is dt else (int(rng.choice(np.concatenate([f for f in model.features(x)]))), int(rng.integers(0, len(pii.STATES))))
                weights[at] += 1e-5
                up = model.gradient(x[None], y, np.ones((1, n), bool))[0]
                weights[at] -= 2e-5
                down = model.gradient(x[None], y, np.ones((1, n), bool))[0]
                weights[at] += 1e-5
                assert abs((up - down) / 2e-5 - grad[at]) < 1e-5


def test_pii_time_is_linear():
    unit = "ask Mr. Smith at 10.0.0.1 or a@b.cd, call (555) 123-4567 "
    took = []
    for n in (4_000, 16_000):
        began = time.process_time()
        base, every = pii.all_spans([unit * n])[0]
        took.append(time.process_time() - began)
        assert len(base) == 2 * n and len(every) == 4 * n
    assert took[1] < 10 * took[0]
    base = [("ip", 5, 12), ("card", 8, 20), ("email", 30, 40)]
    extra = [("name", 0, 5), ("tel", 12, 14), ("tel", 19, 25), ("id", 20, 29), ("name", 39, 50)]
    assert pii.merged(base, extra) == [("name", 0, 5), ("ip", 5, 12), ("card", 8, 20), ("id", 20, 29), ("email", 30, 40)]


def test_pii_planted_secrets_are_removed(spark):
    docs = common.table(spark, "/root/testdata/sf0.1", "documents").where("text rlike '(?i)token = \"[0-9a-f]{40}\"'")
    planted = {r["doc_id"]: re.findall(r'(?i)token = "([0-9a-f]{40})"', r["text"]) for r in docs.collect()}
    assert sum(map(len, planted.values())) > 100
    for r in pii.redact(docs).collect():
        assert not any(s in r["text"] for s in planted[r["doc_id"]]) and 'oken = "<SECRET>"' in r["text"].replace("TOKEN", "token")


def test_pii_secrets_by_key_and_value():
    code = hashlib.sha256(b"another").hexdigest()
    for t, secrets in (
        (f'so token = "{code[:40]}" is set', [code[:40]]),
        (f"so secret = {code} is set", [code]),
        (f'so TOKEN = "{code[:40].upper()}"!! IS', [code[:40].upper()]),
        (f'so "token": "{code[:40]}", is', [code[:40]]),
        (f'so token ="{code[:40]}" is set', [code[:40]]),
        ('so password = "horsebattery" is set', ["horsebattery"]),
        ('so password: "horsebattery" is set', ["horsebattery"]),
        (f"so commit = {code[:40]} is set", []),
        (f"so digest {code[:40]} is set", []),
        ("so your password was lost by them", []),
    ):
        assert [t[a:b] for k, a, b in pii.all_spans([t])[0][1] if k == "secret"] == secrets, t
    for t, spans in (("so my name is Anna Smith, and", ["Anna Smith"]), ("the password is hunter22 now", ["hunter22"]), ("x 5 " + "aaa bbb " * 7 + "Mr. Smith was there", ["Smith"])):
        assert [t[a:b] for _, a, b in pii.all_spans([t])[0][1]] == spans


# 6 ----------------------------------------------------------------------------------------------------------------


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(7)
    y = rng.random(20_000) < 0.8
    counts = {}
    right = np.linspace(0.7, 0.95, quality.LABELLERS)
    v = np.where(rng.random((20_000, quality.LABELLERS)) < right, np.where(y, quality.GOOD, quality.BAD)[:, None], np.where(y, quality.BAD, quality.GOOD)[:, None])
    v[rng.random(v.shape) < 0.2] = quality.ABSTAIN
    for row in v:
        p = quality.pattern(tuple(row.tolist()))
        counts[p] = counts.get(p, 0) + 1
    posterior, chance, share = quality.label_model(counts)
    assert abs(share - 0.8) < 0.02
    assert np.abs(chance[:, 1, quality.GOOD] / (chance[:, 1, 1:].sum(1)) - right).max() < 0.05
    truth = [posterior[quality.pattern(tuple(r.tolist()))] >= 0.5 for r in v]
    assert (np.array(truth) == y).mean() > 0.97


def test_label_model_against_plain_expectation_maximisation():
    """Document by document, with loops, from the same start and priors."""
    rng = np.random.default_rng(1)
    docs = [tuple(rng.integers(0, 3, quality.LABELLERS).tolist()) for _ in range(80)]
    counts = {}
    for v in docs:
        counts[quality.pattern(v)] = counts.get(quality.pattern(v), 0) + 1
    posterior, chance, share = quality.label_model(counts, rounds=7)
    q = {}
    for v in docs:
        good, bad = v.count(quality.GOOD) + 1, 2 * v.count(quality.BAD) + 1
        q[v] = good**2 / (good**2 + (2 * bad) ** 2)
    for _ in range(7):
        prior = sum(q[v] for v in docs) / len(docs)
        table = {}
        for j in range(quality.LABELLERS):
            for c, extra in enumerate(((0.2, 0.6, 0.2), (0.2, 0.05, 1.0))):
                soft = [extra[x] + sum(q[v] if c else 1 - q[v] for v in docs if v[j] == x) for x in range(3)]
                table[j, c] = [x / sum(soft) for x in soft]
        new = {}
        for v in docs:
            odds = [(1 - prior), prior]
            for j, x in enumerate(v):
                odds = [odds[c] * table[j, c][x] for c in range(2)]
            new[v] = odds[1] / sum(odds)
        q = new
    assert abs(share - prior) < 1e-9 and all(abs(posterior[quality.pattern(v)] - q[v]) < 1e-9 for v in docs)
    assert all(np.allclose(chance[j, c], table[j, c]) for j, c in table)


def test_scorer_sees_whole_words_and_equals_its_definition():
    assert quality.word_features("a" + "-b" * 9)[1] != quality.word_features("a" + "-b" * 8 + "-9")[1]
    rng = np.random.default_rng(2)
    w = rng.normal(0, 1, quality.BUCKETS + 1)
    text = "Some words, here. And 12 more; " * 30 + "\nend"
    u, c = quality.text_counts(text, quality.statistics(text))
    z = w[u] @ c + w[-1]
    assert abs(quality.Scorer(w).score(text, quality.statistics(text)) - 1 / (1 + np.exp(-z))) < 1e-9


def test_quality_agrees_with_hidden_labels(spark, odd, none):
    d = "/root/testdata/sf0.1"
    got = quality.classify(common.table(spark, d, "documents")).join(common.table(spark, d, "labels"), "doc_id").toPandas()
    assert (got.predicted == got.quality).mean() > 0.93
    assert got[got.quality == 1].predicted.mean() > 0.95
    rows = quality.classify(odd).collect()
    assert len(rows) == 9 and all(r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert quality.classify(none).count() == 0


# 7 ----------------------------------------------------------------------------------------------------------------


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(ids, fps):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    smallest = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return [smallest[find(i)] for i in range(len(ids))]


def test_simhash_against_brute_force(spark, docs, odd, none):
    extra = docs.select("doc_id", "text").limit(150).unionByName(odd.select("doc_id", "text"))
    rows = extra.collect()
    fps = [plain_simhash(r["text"] or "") for r in rows]
    want = sorted(zip([str(r["doc_id"]) for r in rows], [f"{f:016x}" for f in fps], plain_components([r["doc_id"] for r in rows], fps), strict=True), key=str)
    got = sorted(((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == want
    assert simhash.near_duplicates(none).count() == 0
    assert len(simhash.near_duplicates(odd).columns) == 3


def test_golay_keys_miss_no_link():
    code, rng = simhash.Golay(), np.random.default_rng(8)
    assert sorted(np.unique((code.errors >= 0).sum(1))) == [1, 6]
    a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in a], np.uint64)
    ra, ka = simhash.golay_keys(a, code)
    rb, kb = simhash.golay_keys(a ^ flips, code)
    sets = [set(), set()]
    for s, r, k in ((sets[0], ra, ka), (sets[1], rb, kb)):
        s.update(zip(r.tolist(), k.tolist(), strict=True))
    assert {r for r, _ in sets[0] & sets[1]} == set(range(len(a)))


def test_dense_groups_are_linked_exactly(spark):
    """A cluster whose members lie up to 8 bits apart, a chain, and strangers."""
    rng = np.random.default_rng(9)
    fps = [int(x) for x in rng.integers(0, 2**62, 150)]
    fps += [fps[0] ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in range(250)]
    chain = fps[1]
    for k in range(12):
        chain ^= 0b1111 << (4 * k)
        fps.append(chain)
    fps = sorted(set(fps))
    signed = [struct.unpack("<q", struct.pack("<Q", f))[0] for f in fps]
    got = {r["node"]: r["root"] for r in simhash.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = plain_components(signed, fps)
    mine = [got.get(f, f) for f in signed]
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_hot_keys_are_dealt_by_varying_bits(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    fps = sorted({base ^ sum(1 << int(b) for b in rng.choice(30, rng.integers(0, 12), replace=False)) for _ in range(300)})
    df = spark.createDataFrame([(7, f, k) for k, f in enumerate(fps)], "key long, fp long, label long")
    dealt = {}
    for r in simhash.by_varying_bits(df).collect():
        dealt.setdefault((r["fifth"], r["part"]), set()).add(r["fp"])
    pairs = {(a, b) for g in dealt.values() for a in g for b in g if a < b and bin(a ^ b).count("1") <= 4}
    assert pairs == {(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 4}
    assert max(map(len, dealt.values())) < len(fps) / 2


def test_keep_first(spark, odd):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    rows = sorted(str((r["doc_id"], r["text"])) for r in kept.collect())
    assert len(rows) == 5 and str((1, None)) in rows and str((5, "same text here")) in rows


# 8 ----------------------------------------------------------------------------------------------------------------


def plain_distance(item, words):
    """Least edit distance of the item to any run of words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_recall_and_exactness(spark, sf_dir, odd, none):
    bench = common.table(spark, sf_dir, "benchmark")
    items = {r["item_id"]: [w.lower() for w in re.findall(r"\w+", r["text"])] for r in bench.collect()}
    rng = random.Random(10)
    pool = sorted({w for ws in items.values() for w in ws})
    rows, want = [], set()
    for q in range(300):
        item = rng.choice(sorted(items))
        words = list(items[item])
        for _ in range(rng.randint(0, decontaminate.edits(len(words)) + 2)):
            kind, at = rng.randrange(3), rng.randrange(len(words))
            if kind == 0:
                words[at] = f"zz{q}"
            elif kind == 1:
                words.insert(at, rng.choice(pool))
            else:
                words.pop(at)
        around = [rng.choice(pool) for _ in range(rng.randint(0, 20))]
        rows.append((q, " ".join([*around, *words, *around]).capitalize()))
    texts = {q: [w.lower() for w in re.findall(r"\w+", t)] for q, t in rows}
    want = {(q, i) for q, ws in texts.items() for i, it in items.items() if plain_distance(it, ws) <= decontaminate.edits(len(it))}
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    got = decontaminate.find(df, bench).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert pairs <= want and len(pairs) >= 0.97 * len(want) and len(pairs) == len(got)
    for r in got:
        ws = [w.lower() for w in re.findall(r"\w+", rows[r["doc_id"]][1][r["start"] : r["end"]])]
        assert plain_distance(items[r["item_id"]], ws) == r["edits"] == plain_distance(items[r["item_id"]], texts[r["doc_id"]])
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()}
    assert kept == set(texts) - {q for q, _ in pairs}
    assert decontaminate.find(odd, bench).count() == 0 and decontaminate.find(none, bench).count() == 0
    assert decontaminate.find(odd, spark.createDataFrame([(None, "a b c d e f g"), (1, None), (2, "a b")], "item_id long, text string")).count() == 0


def test_decontamination_items_of_any_length(spark):
    rng = random.Random(13)
    pool = [f"w{i}" for i in range(3000)]
    long = [rng.choice(pool) for _ in range(640)]
    items = {1: ["sesame"], 2: ["open", "sesame"], 3: ["a", "b", "c", "d"], 4: long, 5: [rng.choice(pool) for _ in range(6000)]}
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    edited = [w for i, w in enumerate(long) if i % 7]
    rows = {
        1: ["now", "sesame", "x"],
        2: ["Open", "Sesame"],
        3: ["z", "A", "b,", "c", "d", "z"],
        4: ["a", "b", "c", "e"],
        5: ["pre", *edited, "post"],
        6: long[100:],  # within a fifth, none of them in the first part
        7: long[:400],  # beyond a fifth
        8: items[5][:5500],
        9: [*long[:300], *long[340:]],
    }
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in rows.items()], "doc_id long, text string")
    want = {(k, i) for k, t in rows.items() for i, it in items.items() if i < 5 and plain_distance(it, [re.sub(r"\W", "", w).lower() for w in t]) <= decontaminate.edits(len(it))} | {(8, 5)}
    assert {(5, 4), (6, 4), (9, 4), (2, 1)} <= want and (7, 4) not in want
    for most in (decontaminate.BLOCK_BYTES, 100):  # one block, and a block for each item
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(df, bench, block_bytes=most).collect()} == want
        assert {r["doc_id"] for r in decontaminate.drop_contaminated(df, bench, block_bytes=most).collect()} == set(rows) - {k for k, _ in want}


def test_walks_alone_reach_their_recall():
    """Keys of an edited item's window against an index of many items, without any other help."""
    rng = random.Random(14)
    pool = [f"w{i}" for i in range(2000)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(15, 60)))) for i in range(300)]
    items = decontaminate.Items(rows)
    found = 0
    for k, seq in enumerate(items.seqs):
        words = seq.tolist()
        for _ in range(decontaminate.edits(len(words))):
            kind, at = rng.randrange(3), rng.randrange(len(words))
            words[at : at + (kind != 1)] = [] if kind == 2 else [rng.randrange(1, items.base)]
        windows = np.array([[0, len(seq)]])
        found += any(i == k for _, i, _ in items.candidates([(0, np.array(words), windows)]))
    assert found >= 0.95 * len(rows)


# 9 ----------------------------------------------------------------------------------------------------------------


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        assert sorted(shards.feistel(np.arange(n), n).tolist()) == list(range(n))
    assert shards.feistel(np.arange(50), 50, 1).tolist() != shards.feistel(np.arange(50), 50, 2).tolist()


def test_shards_hold_every_token(spark, docs, odd, none, tmp_path):
    enc = shards.encoding()
    for df in (docs, odd):
        listed = shards.write_shards(df, f"file://{tmp_path}/{len(df.columns)}", length=128, per_shard=64)
        files = sorted(((r["shard"], r["path"], r["sequences"], r["first_slot"]) for r in listed.collect()))
        data = b"".join(open(f[1].removeprefix("file://"), "rb").read() for f in files)
        assert [f[3] for f in files] == [64 * f[0] for f in files] and len(data) == 256 * sum(f[2] for f in files)
        ids = np.frombuffer(data, "<u2")
        ids = ids[ids != shards.PAD_ID]
        want = [t for r in df.collect() for t in [*enc.encode_ordinary(r["text"] or ""), shards.END_ID]]
        assert np.array_equal(np.bincount(ids, minlength=65536), np.bincount(want, minlength=65536))
        rows = shards.read_shards(listed, 128, 64).orderBy("slot").collect()
        assert [r["slot"] for r in rows] == list(range(len(data) // 256))
        part = shards.read_shards(listed, 128, 64, 10, 20).orderBy("slot").collect()
        assert part == [r for r in rows if 10 <= r["slot"] < 20]
    assert shards.round_trip(spark, none).count() == 0


# 10 ---------------------------------------------------------------------------------------------------------------


def ids_of(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_word_cache_equals_the_tokenizer():
    t = tokens.WordTokenizer(tokens.vocabulary(), entries=300)
    rng = random.Random(2)
    letters = "aAbH'sStT.,!é̱́İΣσς1२９|<>-_ \n\t\x1c\x85 한ﬁ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + ["It's <|endoftext|>. x", "a <|STARTOFTEXT|> b", "A<|startoftext|>B <|EndOfText|> C"]
    pieces = ("<|startoftext|>", "<|STARTOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|", "|>", "Word", "X.", " ", "endoftext", "\u0301")
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(1000)]
    for lo in range(0, len(texts), 100):
        some = texts[lo : lo + 100]
        for text, raw in zip(some, t.encode([x.encode() for x in some]), strict=True):
            assert ids_of(raw) == t.model.encode(text, add_special_tokens=False).ids, text


def check_packing(df, rows, capacity=4096):
    model = tokens.tokenizer(tokens.vocabulary()).model
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    mine = sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    want = []
    for r in df.collect():
        ids = [*model.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for p, lo in enumerate(range(0, len(ids), capacity)):
            part = ids[lo : lo + capacity]
            want.append(str((r["doc_id"], p, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))))
    assert mine == sorted(want)
    return len(bins)


def test_packing(spark, docs, odd, none):
    rows = packing.pack(docs).collect()
    used = check_packing(docs, rows)
    assert used <= 1.03 * -(-sum(r["length"] for r in rows) // 4096)
    check_packing(odd, packing.pack(odd).collect())
    assert packing.pack(none).count() == 0
    small = docs.limit(40)
    check_packing(small, packing.pack(small, capacity=64).collect(), 64)


def plain_best_fit(lengths, capacity):
    """Best-fit decreasing, one piece at a time."""
    room = []
    for n in sorted(lengths.tolist(), reverse=True):
        at = bisect.bisect_left(room, n)
        bisect.insort(room, (room.pop(at) if at < len(room) else capacity) - n)
    return len(room)


@pytest.mark.parametrize("kind", ["uniform", "large", "thirds", "geometric", "log-normal", "halves"])
def test_packing_plans(kind):
    rng = np.random.default_rng(len(kind))
    lengths = {
        "uniform": rng.integers(1, 4097, 20_000),
        "large": rng.integers(1500, 4097, 20_000),
        "thirds": rng.integers(1200, 1500, 20_000),
        "geometric": np.minimum(4096, rng.geometric(0.002, 20_000)),
        "log-normal": np.clip(rng.lognormal(6.5, 1, 20_000), 1, 4096).astype(int),
        "halves": np.array([2049, 2048, 2047, 1] * 500),
    }[kind]
    counts = np.bincount(lengths, minlength=4097)
    plan = packing.plan_packing(counts)
    assert all(plan.rank.get(n, 0) == counts[n] for n in range(1, 4097))
    assert -(-int(lengths.sum()) // 4096) <= plan.sequences <= plain_best_fit(lengths, 4096)


@pytest.mark.parametrize("low, high, n", [(420, 512, 20_000), (300, 511, 30_000), (1000, 1500, 20_000), (100, 128, 30_000), (2000, 2100, 5_000)])
def test_packing_groups_lengths_of_any_size(low, high, n):
    """Short documents alone reach the grouping scheme too: no variant of it is clearly better than the plan."""
    lengths = np.random.default_rng(low).integers(low, high + 1, n)
    counts = np.bincount(lengths, minlength=4097)
    plan = packing.plan_packing(counts)
    others = [packing.grouped_plan(counts, 4096, groups, small).sequences for groups in (48, 96) for small in (4, 8, 16, 32, 64)]
    assert all(plan.rank.get(k, 0) == counts[k] for k in range(1, 4097))
    assert plan.sequences <= 1.005 * min([*others, plain_best_fit(lengths, 4096)])


@pytest.mark.parametrize("kind", ["log-normal", "geometric", "tiny", "one", "documents"])
def test_packing_plans_go_through_configurations(spark, docs, monkeypatch, kind):
    """Also where plain best fit fills every sequence, and where all lengths are below the least limit."""
    rng = np.random.default_rng(5)
    lengths = {
        "log-normal": lambda: np.clip(rng.lognormal(6.5, 1, 20_000), 1, 4096).astype(int),
        "geometric": lambda: np.minimum(4096, rng.geometric(0.002, 20_000)),
        "tiny": lambda: rng.integers(1, 50, 9_000),
        "one": lambda: np.ones(10_000, int),
        "documents": lambda: np.array([r["length"] for r in packing.pack(docs).select("length").collect()]),
    }[kind]()
    used, plain = [], packing.configurations
    monkeypatch.setattr(packing, "configurations", lambda *a, **k: used.append(plain(*a, **k)) or used[-1])
    plan = packing.plan_packing(np.bincount(lengths, minlength=4097))
    assert used and all(used)
    assert all(plan.rank.get(n, 0) == k for n, k in enumerate(np.bincount(lengths)) if n)
    assert plan.sequences <= 1.005 * plain_best_fit(lengths, 4096)


def test_dearest_configuration():
    rng = np.random.default_rng(2)
    for _ in range(40):
        sizes = np.unique(rng.integers(3, 40, rng.integers(1, 6)))
        price = rng.random(len(sizes))
        copies, value = packing._dearest(sizes, price, 60)
        best = np.zeros(61)
        for c in range(61):
            best[c] = max([0.0, *(best[c - s] + p for s, p in zip(sizes, price, strict=True) if s <= c)])
        assert abs(value - best[60]) < 1e-9 and copies @ sizes <= 60 and abs(copies @ price - value) < 1e-9
