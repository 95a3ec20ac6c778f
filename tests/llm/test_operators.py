"""The operators against plain versions, on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import itertools
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from strataflow.llm import batches, bpe, hpylm, jaccard, licenses, pii, ppm, pstable, raking, spotsigs, warc
from strataflow.llm.components import components
from strataflow.llm.words import shingle_sets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi".split()


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def sentence(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """(id, text) rows: copies, near copies, short, empty, null, wordless, very long, without id, repeated."""
    draw = random.Random(5)
    rows, base = [], [sentence(draw, n) for n in (40, 80, 160, 240)]
    for i, text in enumerate(base):
        rows += [(10 * i + 3, text), (10 * i + 4, text.upper()), (10 * i + 5, text + "\n" + sentence(draw, 4))]
        w = text.split()
        for k in range(3):
            w[draw.randrange(len(w))] = "changed"
            rows.append((10 * i + 6 + k, " ".join(w)))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "ONE"), (105, "one two three"), (106, "one  two\nthree")]
    rows += [(110, sentence(draw, 30000)), (None, base[0]), (None, None), (111, base[1]), (111, base[1]), (112, "é ñ ü 日本 🙂 x")]
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)


def least_reachable(ids, links):
    top = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(top[a], top[b])
            changed |= top[a] != m or top[b] != m
            top[a] = top[b] = m
    return top


# --- helpers


def test_pieces_hold_every_row_once():
    rows = ["a" * n for n in (0, 5, 100, 1, 0, 7)] + [None]
    ranges = list(batches.pieces(rows, 10))
    assert [i for lo, hi in ranges for i in range(lo, hi)] == list(range(len(rows)))
    assert list(batches.pieces([], 10)) == []


def test_components_of_chains_rings_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 102), (102, 100)] + [(200, 200 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component_id for r in components(frame).collect()}
    assert got == least_reachable({x for e in edges[:-2] for x in e}, edges[:-2])
    assert components(frame.limit(0)).count() == 0


# --- 1 vectors


def vectors():
    draw = np.random.default_rng(1)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            centre = draw.standard_normal(16)
            for spread in (0, 0.02, 0.08, 0.12):
                v = centre + spread * draw.standard_normal(16) * np.linalg.norm(centre) / 4
                rows.append((n, [float(np.float32(x)) for x in v], label))
                n += 1
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [math.nan] * 16, 0), (n + 3, [None] + [1.0] * 15, 1), (n + 4, [], 1)]
    rows += [(n + 5, [math.inf] + [1.0] * 15, 1), (n + 6, rows[0][1], 0), (n + 7, rows[0][1], 0), (n + 8, rows[0][1][:8], 0), (n + 7, rows[0][1], 0)]
    return [*rows, (None, rows[0][1], 0)]


def plain_links(rows):
    good = {i: (np.array(v), c) for i, v, c in rows if i is not None and c is not None and v and None not in v}
    good = {i: x for i, x in good.items() if np.isfinite(x[0]).all() and x[0].any()}
    links = []
    for a, b in itertools.combinations(sorted(good), 2):
        (x, c), (y, d) = good[a], good[b]
        if c == d and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
            links.append((a, b))
    return links


@pytest.mark.parametrize("block", [4, 512])
def test_vectors_equal_all_pairs(spark, block):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit(1))
    got = {r.vec_id: r for r in pstable.near_duplicates(frame, block=block).collect()}
    links = plain_links(rows)
    degree = Counter(x for link in links for x in link)
    ids = {i for i, _, _ in rows if i is not None}
    top = least_reachable(ids, links)
    assert set(got) == ids | {None}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items() if i is not None} == {
        i: (degree[i], top[i], top[i] == i) for i in ids
    }
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)


@pytest.mark.parametrize("options", [{}, {"tables": 2, "block": 4}])
def test_vectors_that_share_no_bucket_are_linked(spark, options):
    """Pairs just above the threshold, of which hashing leaves out one in a thousand, or most of them with few tables."""
    draw = np.random.default_rng(5)
    n = 4000 if not options else 600
    x, y = draw.standard_normal((2, n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    both = np.stack([x, 0.9301 * x + math.sqrt(1 - 0.9301**2) * y], axis=1).reshape(-1, 64)
    rows = [(i, v, 1) for i, v in enumerate(both.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pstable.near_duplicates(frame, **options).collect()}
    assert got == {i: (1, i - i % 2) for i in range(2 * n)}


@pytest.mark.parametrize("options", [{}, {"tables": 1, "width": 1e4}, {"tables": 1, "width": 1e-3}, {"block": 8}])
def test_chains_of_vectors_stay_whole(spark, options):
    """Walks of steps at cosine 0.94, by default tables, in one bucket or in none: a link also counts for the components where
    both of its vectors have neighbours with smaller ids. The last walk is the shortest of that kind."""
    draw = np.random.default_rng(11)
    walks = []
    for _ in range(60):
        walks.append(draw.standard_normal(64))
        walks[-1] /= np.linalg.norm(walks[-1])
        for _ in range(19):
            aside = draw.standard_normal(64)
            aside -= (aside @ walks[-1]) * walks[-1]
            walks.append(0.94 * walks[-1] + math.sqrt(1 - 0.94**2) * aside / np.linalg.norm(aside))
    ids, labels = draw.permutation(len(walks)).tolist(), [i // 20 % 3 for i in range(len(walks))]
    rows = list(zip(ids, [v.tolist() for v in walks], labels, strict=True))
    rows += [(2000 + i, [math.cos(turn), math.sin(turn)], 0) for i, turn in ((0, 0.0), (2, 0.35), (3, 0.7), (1, 1.05))]
    unit, label = np.array(walks), np.array(labels)
    links = [(ids[i], ids[j]) for i, j in np.argwhere(np.triu((unit @ unit.T >= 0.93) & (label[:, None] == label), 1))]
    links += [(2000, 2002), (2002, 2003), (2003, 2001)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pstable.near_duplicates(frame, **options).collect()}
    degree, top = Counter(x for link in links for x in link), least_reachable([i for i, _, _ in rows], links)
    assert got == {i: (degree[i], top[i]) for i in top}


def test_groups_of_links():
    """Rows point at the first row of their group, whatever the order in which links come."""
    draw = np.random.default_rng(2)
    for n, m in ((4, 3), (50, 20), (50, 60), (400, 390)):
        a, b = draw.integers(0, n, (2, m))
        root = np.arange(n)
        for k in range(0, m, 7):
            root = pstable.grouped(root, a[k : k + 7], b[k : k + 7])
        top = least_reachable(range(n), list(zip(a.tolist(), b.tolist(), strict=True)))
        assert root.tolist() == [top[i] for i in range(n)]


def test_vectors_at_the_threshold(spark):
    """Cosines of 93/100 as it is, and of a little less; a pair counts for both of its vectors."""
    at, below = [93.0, 36.0, 7.0, 2.0, 1.0, 1.0], [93.0, 36.0, 7.0, 2.0, 1.0, 1.00001]
    first = [1.0] + [0.0] * 5
    rows = [(0, first, 1), (1, at, 1), (2, first, 2), (3, below, 2)]
    rows += [(4, [x * 2.0**900 for x in first], 3), (5, [x * 2.0**-900 for x in at], 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in pstable.near_duplicates(frame).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 4: 1, 5: 1}


def test_codes_do_not_depend_on_the_batch():
    unit = pstable.normal(np.random.default_rng(3).standard_normal((300, 64)))
    whole = pstable.codes(unit, 32, 10, 2.0, 1)
    for rows in (1, 3, 17):
        assert (np.concatenate([pstable.codes(unit[k : k + rows], 32, 10, 2.0, 1) for k in range(0, 300, rows)]) == whole).all()


def test_no_vectors(spark):
    assert pstable.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# --- 2 shingles


def plain_sets(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return sets


def test_shingle_hashes_stand_for_shingles(texts):
    for (_, text), hashes in zip(texts, shingle_sets([t for _, t in texts]), strict=True):
        assert len(hashes) == len(plain_sets([(0, text)])[0])


@pytest.mark.parametrize("block", [2, 256])
def test_jaccard_equals_all_pairs(spark, texts, block):
    sets = plain_sets([r for r in texts if r[0] is not None])
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    top = least_reachable(sets, links)
    got = jaccard.similar_sets(documents(spark, texts).withColumn("component_id", F.lit(0)), block=block, slots=1 << 16).collect()
    assert len(got) == len(texts)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {(i, len(sets[i]), top[i]) for i in sets}
    assert sorted((r.n_shingles, r.component_id is None) for r in got if r.doc_id is None) == [(0, True), (36, True)]


def test_jaccard_of_nothing(spark):
    assert jaccard.similar_sets(documents(spark, [])).count() == 0
    got = jaccard.similar_sets(documents(spark, [(1, None), (2, "")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]


def test_large_groups_are_compared_whole(spark, monkeypatch):
    """Two families that differ from each other, in several blocks each, held against each other in shares."""
    monkeypatch.setattr(jaccard, "SHARE", 3)
    draw = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):
        one, two = base.copy(), [*base[:170], *[f"v{k}" for k in range(30)]]
        for _ in range(2):
            one[draw.randrange(60, 200)] = f"x{draw.random()}"
            two[draw.randrange(0, 60)] = f"y{draw.random()}"
        rows += [(i, " ".join(one)), (100 + i, " ".join(two))]
    sets = plain_sets(rows)
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    got = jaccard.similar_sets(documents(spark, rows), block=4, slots=1 << 16).collect()
    assert {r.doc_id: r.component_id for r in got} == least_reachable(sets, links)


# --- 3 licences


@pytest.fixture(scope="module")
def classifier():
    draw = random.Random(9)
    return licenses.train([sentence(draw, draw.randrange(1, 20)) for _ in range(300)])


def test_licences_found(spark, classifier):
    draw = random.Random(4)
    long = sentence(draw, 500)
    rows = [
        (1, long + "\nReleased under the MIT License."),
        (2, long + " This work is licensed under the GNU General Public License, version 3. " + long),
        (3, long), (4, None), (5, ""), (6, "\n\n"), (7, "All rights reserved."),
        (8, "LICENSED UNDER CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."),
        (8, "Licensed under CC BY 4.0."), (None, "licensed under the mit license"),
    ]
    frame = documents(spark, rows).withColumn("Licenses", F.lit("x"))
    got = [(r.doc_id, ",".join(r.licenses), r.n_notices) for r in licenses.scan(frame, classifier, keep=["doc_id", "Licenses"]).collect()]
    assert got == [
        (1, "MIT", 1), (2, "GPL", 1), (3, "", 0), (4, "", 0), (5, "", 0), (6, "", 0), (7, "unknown", 1),
        (8, "Apache-2.0,CC-BY-NC", 2), (8, "CC-BY", 1), (None, "MIT", 1),
    ]
    assert licenses.scan(documents(spark, []), classifier).count() == 0


def test_licences_on_held_out_variants(classifier):
    draw = random.Random(8)
    right = total = 0
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            line = f"{sentence(draw, 3)} {t} {sentence(draw, 2)}"
            right += licenses.scan_lines(classifier, [line]).get(0) == {family}
            total += 1
    assert right / total >= 0.9
    clean = [sentence(draw, 15) for _ in range(200)]
    assert licenses.scan_lines(classifier, clean) == {}


def test_wrapped_licences(classifier):
    """Every template that 72 columns break, as a comment, between paragraphs and below prose, names its family."""
    draw = random.Random(12)
    wrapped = 0
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            lines = textwrap.wrap(t, 72)
            if len(lines) == 1:
                continue
            wrapped += 1
            for mark in ("", "# ", " * "):
                text = f"{sentence(draw, 30)}\n\n" + "\r\n".join(mark + x for x in lines) + f"\n{mark}\n{sentence(draw, 30)}"
                got = licenses.scan_paragraphs(classifier, licenses.paragraphs_of(text))
                assert [f for f, _ in got] == [set(), {family}, set()] and got[1][1] >= 1, (lines, got)
    assert wrapped >= 8
    prose = [sentence(draw, 11) for _ in range(300)]
    assert licenses.scan_paragraphs(classifier, [prose]) == [(set(), 0)]
    separate = ["All rights reserved.", *textwrap.wrap(licenses.TEMPLATES["BSD"][1], 72), "Released under the MIT License."]
    assert licenses.scan_paragraphs(classifier, [separate]) == [({"unknown", "BSD", "MIT"}, 3)]


def test_licence_fit_without_rows(spark):
    assert licenses.fit(documents(spark, [])).classes[0] == licenses.NONE


# --- 4 spot signatures


def plain_spots(text):
    w, out, anchors = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if x], set(), set(spotsigs.ANCHORS)
    for i, x in enumerate(w):
        if x in anchors:
            chain = [y for j, y in enumerate(w[i + 1 :], i + 1) if y not in anchors or j == len(w) - 1][:2]
            if len(chain) == 2:
                out.add((x, *chain))
    return out or {(" ".join(w),)}


def spot_rows():
    draw = random.Random(6)
    pool = [*WORDS, "the", "a", "is", "of", "und", "la"]
    texts = [" ".join(draw.choice(pool) for _ in range(n)) for n in (3, 9, 30, 60, 120, 400)]
    rows = [(7 * i, t) for i, t in enumerate(texts)] + [(50, None), (51, ""), (52, texts[3]), (53, "the"), (60, texts[4] + " the end of it"), (1000, "é the ñandú über")]
    return rows


@pytest.mark.parametrize("spread", [1, 2048])
def test_spots_equal_plain(spark, monkeypatch, spread):
    rows = spot_rows()
    monkeypatch.setattr(spotsigs.successor, "__defaults__", (spread,))
    frame = documents(spark, rows).withColumn("fingerprint", F.lit(1))
    got = {r.doc_id: r for r in spotsigs.edited_likeness(frame).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    jac = lambda x, y: len(x & y) / len(x | y)
    for at, (i, t) in enumerate(order):
        t, after = t or "", order[(at + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert len(r.fingerprint) == 16 * len(plain_spots(t))
        assert r.near_edited == pytest.approx(jac(plain_spots(t), plain_spots(edited)))
        assert r.near_next == pytest.approx(jac(plain_spots(t), plain_spots(after)))
    assert got[21].fingerprint == got[52].fingerprint != got[28].fingerprint


def test_spots_of_odd_tables(spark):
    assert spotsigs.edited_likeness(documents(spark, [])).count() == 0
    one = spotsigs.edited_likeness(documents(spark, [(5, "the cat sat")])).collect()[0]
    assert (one.near_next, one.n_chars) == (1.0, 11)
    rows = spotsigs.edited_likeness(documents(spark, [(None, "x the y z"), (2, "b"), (2, "b"), (None, None)])).collect()
    assert sorted(r.n_chars for r in rows) == [0, 1, 1, 9]


def test_spot_classes(spark):
    rows = [r for r in spot_rows() if r[0] is not None]
    sets = {i: plain_spots(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])]
    got = {r.doc_id: (r.n_signatures, r.class_id) for r in spotsigs.matches(documents(spark, rows)).collect()}
    top = least_reachable(sets, links)
    assert got == {i: (len(sets[i]), top[i]) for i in sets}


# --- 5 WARC


def page_rows():
    draw = random.Random(2)
    big = "<p>" + "".join(draw.choice("abc<>é") for _ in range(3000))
    noise = "".join(chr(draw.randrange(32, 0xD7FF)) for _ in range(40000))
    return [
        (1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9", big), (3, None, "small"), (4, "http://a/\r\nX: 4", "small"),
        (5, "u", None), (6, "u", ""), (7, "u", noise), (None, "u", big), (None, "u", noise + "x"), (9, "http://a/9", big),
    ]


@pytest.mark.parametrize(("range_bytes", "archive_bytes"), [(64, 3000), (1 << 20, 1 << 20)])
def test_archives_come_back(spark, range_bytes, archive_bytes):
    rows = page_rows()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit(0)).repartition(2)
    files = warc.write_archives(frame, archive_bytes=archive_bytes)
    back = warc.read_archives(files, range_bytes=range_bytes).collect()
    assert files.agg(F.sum("records")).first()[0] == len(back) == len(rows)
    got = Counter()
    for r in back:
        name = int(r.record_id[9:]) if r.record_id.startswith("urn:page:") else None
        refers = int(r.refers_to[9:]) if r.refers_to else None
        got[(name, r.payload_bytes, r.payload_digest, r.record_type, refers, None if r.payload is None else bytes(r.payload))] += 1
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == body and k is not None]
        refers = max(same) if len(body) >= 1000 and same and max(same) != i else None
        want[(i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers else "response", refers, None if refers else body)] += 1
    assert got == want
    assert all("\r" not in (r.target_uri or "") for r in back)


def test_false_magic_and_garbage_are_passed_over(spark, tmp_path):
    good = [warc.record(f"urn:page:{i}", "u", "d", "x", bytes([i]) * 50, 50, None) for i in range(3)]
    bad = zlib.compressobj(6, zlib.DEFLATED, 31)
    other = bad.compress(b"no record\r\n\r\n") + bad.flush()
    data = b"junk" + warc.MAGIC + good[0] + other + warc.MAGIC + b"\0" * 9 + good[1] + warc.MAGIC[:2] + good[2] + good[2][:-9]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    files = spark.createDataFrame([(str(path), len(data)), (str(path), 0)], "path string, size long")
    for step in (7, 100, 1 << 20):
        got = warc.read_archives(files, range_bytes=step).collect()
        assert sorted((r.record_id, bytes(r.payload)) for r in got) == [(f"urn:page:{i}", bytes([i]) * 50) for i in range(3)]


def test_no_pages(spark):
    files = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_archives(files).count() == 0


# --- 6 personal data


def plain_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(d) <= 19 and sum((x * 2 - 9 * (x > 4)) if i % 2 else x for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def pii_rows():
    draw = random.Random(12)
    bits = ["a@b.c", "x_y@e.f@g.h", "a@b", "@c.d", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.2.3", "007.08.9.255", "99999999999999999999.1.2.3",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "+1 (743) 555-3824", "+44 20", "+1 2 3 4 5 6 7 8 9", "+", "é🙂", " ", "\n", ".", "-",
            "call me at (415) 555-2671 now", "mail john (at) example (dot) com", "word", "5", "0" * 16, "+0" * 3]
    rows = [(i, "".join(draw.choice(bits) + draw.choice(["", " ", "x"]) for _ in range(draw.randrange(1, 12)))) for i in range(150)]
    return rows + [(200, None), (201, ""), (202, "9" * 20000), (203, "a." * 20000 + "@x.y"), (204, "1.2.3.4 " * 300), (None, "a@b.c"), (3, rows[3][1])]


def test_strict_spans_equal_plain_and_stay(spark):
    rows = pii_rows()
    frame = documents(spark, rows).withColumn("PII_spans", F.lit(0))
    got = pii.find(frame).withColumn("out", pii.redact(F.col("text"), F.col("pii_spans"))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.text or ""
        spans = [(s.kind, s.s, s.e) for s in r.pii_spans]
        assert spans == sorted(spans)
        assert [(s.kind, s.s, s.e) for s in r.pii_spans if s.base] == plain_base(text)
        added = [s for s in r.pii_spans if not s.base]
        for s in added:
            assert not any(s.s < b.e and b.s < s.e for b in r.pii_spans if b is not s)
        assert r.out == text or r.text is None and r.out is None or spans
        for m in plain_base(r.out or ""):
            assert (r.out or "")[m[1] : m[2]] not in {text[s:e] for _, s, e in spans} or m[0] != 0


def test_redacted_text(spark):
    frame = documents(spark, [(1, "é write to a.b@c.de or +1 (743) 555-3824, ok"), (2, "clean 123 text"), (3, "x 1.2.3.4@h.io y")])
    got = pii.find(frame).select("doc_id", pii.redact(F.col("text"), F.col("pii_spans")).alias("out")).collect()
    assert {r.doc_id: r.out for r in got} == {1: "é write to [EMAIL] or [PHONE], ok", 2: "clean 123 text", 3: "x [EMAIL] y"}


def test_reliabilities_find_the_labelers_that_err():
    draw = np.random.default_rng(0)
    rows = Counter()
    for _ in range(4000):
        true = draw.random() < 0.4
        form = 1 if true and draw.random() < 0.9 else -1 if not true and draw.random() < 0.8 else 0
        good = (1 if true else -1) if draw.random() < 0.85 else (-1 if true else 1)
        coin = draw.choice([-1, 1])
        rows[(1, form, good, int(coin), 1, true)] += 1
    patterns = sorted({k[:5] for k in rows})
    counted = [(*p, rows[(*p, True)] + rows[(*p, False)]) for p in patterns]
    soft = pii.reliabilities(counted)
    right = sum(rows[(*p, bool(s > 0.5))] for p, s in zip(patterns, soft, strict=True))
    assert right / 4000 > 0.9
    weights = pii.train([(*r[:-1], 1, 0, r[-1]) for r in counted], soft)
    named = dict(zip(pii.features(), weights[len(pii.KINDS) :], strict=True))
    assert named[("gazetteer", 1, 1)] > named[("gazetteer", -1, 1)] + abs(named[("context", 1, 1)] - named[("context", -1, 1)])


def test_no_documents_no_spans(spark):
    assert pii.find(documents(spark, [])).count() == 0


# --- 7 language model


def test_scores(spark, texts):
    rows = [*texts, *[(1000 + i, sentence(random.Random(i), 30)) for i in range(60)]]
    frame = documents(spark, rows).withColumn("score", F.lit(0))
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = hpylm.score(frame, held, contexts=10).collect()
    assert len(got) == len(rows)
    out = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not out(i) for w in [*words_of(t), None])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in rows:
        w = [*words_of(t), None]
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)
        want[(i, out(i), len(w), sum(x in count for x in w), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in got)


def test_context_helps_on_held_out_texts(spark):
    """Words that follow each other in a fixed order are told by their context, not by how frequent they are."""
    draw, rows = random.Random(1), []
    for i in range(200):
        at = draw.randrange(len(WORDS))
        rows.append((i, " ".join(WORDS[(at + k) % len(WORDS)] for k in range(25))))
    got = hpylm.score(documents(spark, rows), F.col("doc_id") % 5 == 0).filter("held_out").collect()
    assert sum(r.score for r in got) > 0.3 * sum(r.base_score for r in got)


def test_rare_words_are_contexts(spark):
    """A word is told by the rare word before it, however many words are more frequent."""
    rows = [(i, f"rare{i % 1500} tail{i % 1500}") for i in range(4500)]
    held = F.col("doc_id") < 1500
    got = hpylm.score(documents(spark, rows), held).filter("held_out").collect()
    assert len(got) == 1500
    # the start (one of 1500), the tail (told by its context) and the end (told by the tail)
    assert all(r.score > -6 and r.score > 0.7 * r.base_score for r in got)


def test_predictive_probabilities_sum_to_one():
    draw = np.random.default_rng(2)
    width, words = 3, np.sort(draw.integers(0, 1 << 63, 40, dtype=np.uint64))
    pairs = np.unique(draw.integers(0, 40 * width, 70))
    together = draw.integers(1, 60, len(pairs))
    count = np.bincount(pairs // width, together, 40).astype(np.int64) + draw.integers(0, 5, 40) + 1
    data = hpylm.pack(words, count, pairs, together)
    start = np.zeros(2 * width + 4)
    start[:width] = np.bincount(pairs % width, together, width)
    start[width : 2 * width] = np.bincount(pairs % width, minlength=width)
    start[2 * width :] = count.sum(), 40, 0, 40
    start[2 * width + 2] = count.sum() - together.sum() + len(pairs)
    (tables, at_root, root), = hpylm.sweeps(0, data, width, [start], 1)
    assert (tables >= 1).all() and (tables <= together).all() and (root <= at_root).all()
    after = start.copy()
    after[width : 2 * width] = np.bincount(pairs % width, tables, width)
    after[2 * width + 2 :] = at_root.sum(), root.sum()
    totals = hpylm.Totals(after, width)
    p = hpylm.root_probability(at_root, root, totals)
    unknown = hpylm.root_probability(np.zeros(1), np.zeros(1), totals)[0]
    assert p.sum() + unknown == pytest.approx(1)
    for u in range(width):
        seats = np.zeros(41)
        own = pairs % width == u
        np.add.at(seats, pairs[own] // width, together[own] - hpylm.DISCOUNT["context"] * tables[own])
        lone = hpylm.STRENGTH["context"] + hpylm.DISCOUNT["context"] * totals.tables[u]
        q = (seats + lone * np.append(p, unknown)) / (hpylm.STRENGTH["context"] + totals.customers[u])
        assert q.sum() == pytest.approx(1)


def test_seating_follows_the_conditional():
    log, draw = hpylm.stirling(0.5, hpylm.EXACT), np.random.default_rng(3)
    assert np.exp(log[3, 1:4]) == pytest.approx([0.5 * 1.5, 1.5, 1])
    tables = hpylm.seat(draw, np.full(40000, 3), np.full(40000, 0.4), 0.5, log)
    weight = np.exp(log[3, 1:4]) * 0.4 ** np.arange(1, 4)
    assert np.bincount(tables, minlength=4)[1:] / 40000 == pytest.approx(weight / weight.sum(), abs=0.01)
    many = hpylm.seat(draw, np.array([33, 1000, 10**6]), np.array([1.0, 1.0, 1.0]), 0.5, log)
    assert (many >= 1).all() and (many <= [33, 1000, 10**6]).all()


def test_model_of_nothing(spark):
    held = F.lit(True)
    assert hpylm.score(documents(spark, []), held).count() == 0
    got = hpylm.score(documents(spark, [(1, "a b"), (2, None)]), held).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, 3, 0, 0), (2, 1, 0, 0)]


# --- 8 tokens


@pytest.fixture(scope="module")
def vocabulary():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def odd_texts():
    draw = random.Random(7)
    mixed = "".join(chr(draw.choice([draw.randrange(1, 0xD7FF), draw.randrange(32, 127)])) for _ in range(3000))
    return [None, "", " ", "a" * 3000, "   \n\n x", "日本語テキスト" * 50, mixed, "🙂" * 100, "x" * 63, "x" * 64, "x" * 65, "ab" * 33, "Ünïcödé wörds and 1234567!!", "I'll we're"]


def test_tokens_equal_the_public_library(spark, vocabulary):
    with open(vocabulary, "rb") as file:
        ranks = bpe.read_ranks(file.read())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = list(enumerate([*odd_texts(), *odd_texts()[3:5]]))
    frame = documents(spark, rows).withColumn("IDS", F.lit(1))
    got = bpe.tokenize(frame, vocabulary, public_tokenizers.PATTERN, outputs=list(bpe.OUTPUTS)).collect()
    for r in got:
        text = rows[r.doc_id][1] or ""
        ids = plain.encode_ordinary(text)
        assert (r.ids, r.n_tokens, bytes(r.decoded)) == (ids, len(ids), text.encode())
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.tokenize(documents(spark, []), vocabulary, public_tokenizers.PATTERN).count() == 0


def test_memory_of_pieces_is_bounded(vocabulary, monkeypatch):
    with open(vocabulary, "rb") as file:
        coder = bpe.Codec(file.read(), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    texts = [" ".join(f"w{i}x{k}" for k in range(10)) for i in range(30)]
    back = [b"".join(e[2] for e in entries).decode() for entries in coder.encode(texts)]
    assert back == texts and len(coder.known) < 200


# --- 9 languages


def plain_bits(tree_rows, p_rows, text):
    """Code length by the definition: at each byte the longest kept context of the language."""
    bits, data = 0.0, ppm.fold(text)
    for i, symbol in enumerate(data):
        k, context = min(i, ppm.ORDER), 0
        for back in range(1, k + 1):
            context |= data[i - back] << (8 * (back - 1))
        while (k, context) not in tree_rows:
            k -= 1
            context &= (1 << (8 * k)) - 1
        bits -= math.log2(p_rows[tree_rows[(k, context)]][symbol])
    return bits


SAMPLES = {
    "en": "the cat and the dog were in the house with the other animals that they found there ",
    "de": "die katze und der hund waren mit den anderen tieren im haus die sie dort gefunden hatten ",
    "fr": "le chat et le chien étaient dans la maison avec les autres animaux trouvés là ",
}


def test_code_lengths_are_exact():
    trees = [ppm.grow(lang, [text * 6, text[5:] * 3], least=4) for lang, text in SAMPLES.items()]
    model = ppm.build(trees)
    tables = {t.language: ppm.probabilities(t, 10**6) for t in trees}
    for rows, p in tables.values():
        assert p.sum(axis=1) == pytest.approx(np.ones(len(rows)))
    texts = ["the dog", "le chien là", "ß? 日本 \x00", "x", "die katze und the cat " * 3]
    got = ppm.code_lengths(model, texts)
    for i, text in enumerate(texts):
        for j, lang in enumerate(model.languages):
            rows, p = tables[lang]
            assert got[i, j] == pytest.approx(plain_bits(rows, p, text), rel=1e-4)


def test_long_texts_are_scored_whole():
    model = ppm.build([ppm.grow(lang, [text * 6], least=4) for lang, text in SAMPLES.items()])
    long = SAMPLES["en"] * 30000
    once, many = ppm.code_lengths(model, ["the", long, "le"]), ppm.code_lengths(model, [SAMPLES["en"] * 3000])
    assert once[1] == pytest.approx(many[0] * 10, rel=1e-3)
    assert once[[0, 2]] == pytest.approx(np.concatenate([ppm.code_lengths(model, ["the"]), ppm.code_lengths(model, ["le"])]))


def test_small_tables_bound_the_model():
    model = ppm.build([ppm.grow(lang, [text * 6], least=2) for lang, text in SAMPLES.items()], model_bytes=20000)
    assert model.bits.nbytes <= 30000
    assert model.languages[ppm.code_lengths(model, ["the dog and the cat"])[0].argmin()] == "en"


def test_many_languages_keep_their_contexts():
    """Sixty languages that share their letters, told by short texts; none loses a counted context."""
    draw, words = random.Random(17), {}
    for i in range(60):
        words[f"l{i:02}"] = ["".join(draw.choice("abcdefghijklmnopqrst") for _ in range(draw.randrange(3, 7))) for _ in range(40)]
    trees = [ppm.grow(lang, [" ".join(draw.choices(own, k=3000))]) for lang, own in words.items()]
    model = ppm.build(trees)
    texts = [(lang, " ".join(draw.choices(own, k=2))) for lang, own in words.items() for _ in range(5)]
    got = ppm.code_lengths(model, [t for _, t in texts])
    assert np.mean([model.languages[b] == lang for b, (lang, _) in zip(got.argmin(axis=1), texts, strict=True)]) >= 0.98
    tables = ppm.probabilities(trees[7], 10**6)
    assert got[:20, 7] == pytest.approx([plain_bits(*tables, t) for _, t in texts[:20]], rel=1e-4)
    assert ppm.build(trees).bits.nbytes < 2.5 * ppm.build(trees[:30]).bits.nbytes


def test_languages_of_held_out_texts(spark):
    draw, rows = random.Random(11), []
    for i in range(240):
        lang = draw.choice(list(SAMPLES))
        words = SAMPLES[lang].split()
        rows.append((i, " ".join(draw.choice(words) for _ in range(25)), lang, "s", 0))
    rows += [(900, None, "en", "s", 0), (901, "123 !!", "en", "s", 0), (902, "", None, "s", 0), (None, "the cat", "en", "s", 0), (3, rows[3][1], None, "s", 0)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("SCORE", F.lit("x"))
    model = ppm.fit(frame.filter("doc_id % 3 <> 0"))
    got = ppm.predict(frame, model).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0 and r.lang]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.95
    assert {(r.doc_id, r.lang_pred, r.score) for r in got if r.doc_id and r.doc_id >= 900} == {(i, "und", 0.0) for i in (900, 901, 902)}
    assert all(0 <= r.score <= 1 for r in got)
    assert next(r for r in got if r.doc_id is None).lang_pred == "en"
    assert {r.lang_pred for r in ppm.predict(frame, ppm.fit(frame.limit(0))).collect()} == {"und"}
    assert ppm.predict(frame.limit(0), model).count() == 0


# --- 10 mixing


def plain_rake(cells, targets, sweeps=200):
    w = {c: float(n) for c, n in cells.items() if n > 0}
    for _ in range(sweeps):
        for d, target in enumerate(targets):
            sums, there = defaultdict(float), {c[d] for c in w}
            for c, x in w.items():
                sums[c[d]] += x
            whole = sum(target[v] for v in there)
            w = {c: x * target[c[d]] / whole / sums[c[d]] for c, x in w.items()}
    return w


def test_raked_weights_meet_their_targets(spark):
    draw, rows = random.Random(13), []
    for i in range(400):
        rows.append((i, sentence(draw, draw.randrange(1, 30)), draw.choice(["en", "de", None]), draw.choice("aaaab"), 0))
    rows += [(500, None, "en", "a", 0), (501, "", "de", "b", 0), (None, "one two", "en", "a", 0), (7, *rows[7][1:])]
    frame = spark.createDataFrame(rows, DOCS).withColumn("Weight", F.lit("x"))
    got = raking.mix(frame, {"lang": F.col("lang"), "source": F.col("source")}, temper=0.5).collect()
    assert len(got) == len(rows)
    cells = defaultdict(int)
    for _, t, lang, source, _ in rows:
        cells[(lang, source)] += len(words_of(t))
    targets = []
    for d in range(2):
        sums = defaultdict(float)
        for c, n in cells.items():
            sums[c[d]] += n
        targets.append({v: n**0.5 for v, n in sums.items()})
    w, total = plain_rake(cells, targets), sum(cells.values())
    for r in got:
        n = len(words_of(r.text))
        assert r.n_tokens == n
        want = w[(r.lang, r.source)] / cells[(r.lang, r.source)] * total if n else 0
        assert r.weight == pytest.approx(want, rel=1e-6)
        assert 0 <= r.probability <= 1 + 1e-9 and r.copies in (0, 1) and (n or not r.copies)
    assert max(r.probability for r in got) == pytest.approx(1)
    assert len({r.copies for r in got if r.doc_id == 7}) == 1
    share = sum(r.n_tokens * r.probability for r in got if r.source == "b") / sum(r.n_tokens * r.probability for r in got)
    assert share == pytest.approx(targets[1]["b"] / sum(targets[1].values()))


def test_given_targets_and_budget(spark):
    rows = [(i, "one two three four", "en" if i % 4 else "de", "a", 0) for i in range(2000)]
    frame = spark.createDataFrame(rows, DOCS)
    shares = spark.createDataFrame([("=en", 1.0), ("=de", 1.0), ("=xx", 5.0)], "lang string, share double")
    got = raking.mix(frame, {"lang": F.col("lang")}, targets={"lang": shares}, budget=12000).collect()
    tokens = Counter()
    for r in got:
        tokens[r.lang] += r.n_tokens * r.copies
    assert tokens["de"] == 6000 - 4 * 0 and tokens["en"] == pytest.approx(6000, rel=0.1)
    assert raking.mix(frame.limit(0), {"lang": F.col("lang")}).count() == 0


def test_formats(spark):
    texts = {None: "empty", "": "empty", "a | b": "table", "x###": "noise", "HI!! YOU!!": "shouting", "MIT License": "legal", "a@b": "contact", "hi": "prose"}
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.text: r.topic for r in frame.select("text", raking.format_of(F.col("text")).alias("topic")).collect()} == texts
