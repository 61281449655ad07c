import base64
import gzip
import hashlib
import json
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcast.llm import extract, pivots, warc


def sha1(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


@pytest.fixture()
def pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>page {i % 7} " + "word " * (i % 7 * 50)) for i in range(60)]
    rows += [(100, "http://a\r\nb", None), (101, None, ""), (None, None, "é\r\n\r\nWARC/1.1\r\n"), (7, "http://x/7", rows[7][2]),
             (7, "http://x/7", rows[7][2])]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def test_archives_round_trip(spark, pages, tmp_path):
    rows = warc.archived(pages, str(tmp_path / "a"), roll=900).collect()
    given = [(r["page_id"], r["html"] or "") for r in pages.collect()]
    first = {}
    for page, html in sorted(given, key=lambda x: (x[0] is None, x[0])):
        first.setdefault(html, page)
    key = lambda x: str(x)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in rows), key=key) == sorted(
        ((p, len(h.encode()), sha1(h)) for p, h in given), key=key)
    assert sum(r["record_type"] == "response" for r in rows) == len(first)
    by_digest = {sha1(h): p for h, p in first.items()}
    for r in rows:
        assert (r["page_id"] if r["record_type"] == "response" else r["refers_to"]) == by_digest[r["payload_digest"]]
    full = warc.read_archives(spark, str(tmp_path / "a"))
    assert {r["payload"] for r in full.where("record_type = 'response'").collect()} == set(first)


def test_archives_are_deterministic_and_rolled(spark, pages, tmp_path):
    warc.write_archives(pages, str(tmp_path / "a"), roll=900)
    warc.write_archives(pages.repartition(7).orderBy(F.desc("page_id")), str(tmp_path / "b"), roll=900)
    names = sorted(p.name for p in (tmp_path / "a").glob("*.warc.gz"))
    assert len(names) > 3 and names == sorted(p.name for p in (tmp_path / "b").glob("*.warc.gz"))
    for name in names:
        assert gzip.decompress((tmp_path / "a" / name).read_bytes()) == gzip.decompress((tmp_path / "b" / name).read_bytes())
    listed = [json.loads(x) for x in (tmp_path / "a" / "manifest.json").read_text().splitlines()]
    assert [m["file"] for m in listed] == names and sum(m["records"] for m in listed) == pages.count()
    assert not list(Path(tmp_path / "a").glob("_temporary*"))


def test_only_committed_and_sound_archives_are_read(spark, pages, tmp_path):
    folder = tmp_path / "a"
    warc.write_archives(pages, str(folder), roll=900)
    with pytest.raises(FileExistsError):
        warc.write_archives(pages, str(folder))
    (folder / "stray.warc.gz").write_bytes(gzip.compress(b"not listed"))
    assert warc.read_archives(spark, str(folder)).count() == pages.count()
    first = folder / "pages-000000.warc.gz"
    (folder / ".pages-000000.warc.gz.crc").unlink()
    first.write_bytes(gzip.compress(gzip.decompress(first.read_bytes()).replace(b"page 0", b"page 9", 1)))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(spark, str(folder)).collect()


def test_no_pages_and_least_bytes(spark, pages, tmp_path):
    assert warc.archived(pages.limit(0), str(tmp_path / "a")).count() == 0
    rows = warc.archived(pages, str(tmp_path / "b"), least_bytes=10 ** 6).collect()
    assert len(rows) == pages.count() and all(r["record_type"] == "response" for r in rows)


def test_a_failed_move_commits_nothing(spark, pages, tmp_path, monkeypatch):
    """One file cannot be moved: no manifest appears, readers see nothing, and a new folder works."""
    monkeypatch.setattr(warc, "FILES", 3)  # few files: larger ones
    warc.write_archives(pages, str(tmp_path / "few"), roll=100)
    assert len(list((tmp_path / "few").glob("*.warc.gz"))) <= 4
    monkeypatch.setattr(warc, "FILES", 1000)
    folder = tmp_path / "a"
    original = warc.hadoop_fs

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if b.getName() == "pages-000001.warc.gz" else self.fs.rename(a, b)

    monkeypatch.setattr(warc, "hadoop_fs", lambda spark, at: (Broken(original(spark, at)[0]), None))
    with pytest.raises(RuntimeError, match="could not move shard 1"):
        warc.write_archives(pages, str(folder), roll=900)
    assert not (folder / "manifest.json").exists()
    monkeypatch.undo()
    warc.write_archives(pages, str(tmp_path / "b"), roll=900)
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == pages.count()


def brute_force(rows, k):
    usable = [(i, np.floor(np.array(e, float) * 256).astype(int)) for i, e in rows
              if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out, asked = set(), {}
    for i, v in usable:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, tuple(v)), tuple(v))
    for q, v in asked.items():
        scores = sorted((-int(np.dot(v, w)), j) for j, w in usable if j != q and len(w) == len(v))[:k]
        out |= {(q, n, j, -s) for n, (s, j) in enumerate(scores, 1)}
    return out


def test_top_k_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 6))
    rows = [(i, [float(x) for x in np.float32(centres[i % 5] + rng.normal(size=6) * 0.3)]) for i in range(600)]
    rows += [(1000 + i, rows[50][1]) for i in range(200)]                       # one vector, many times
    rows += [(50, rows[50][1]), (2000, [1.0, 2.0]), (2050, [0.5, 0.5]), (2051, []), (2100, [])]
    rows += [(None, rows[0][1]), (2150, None), (2200, [float("nan")] * 6), (2250, [None] + [1.0] * 5), (2300, [float("inf")] * 6)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    for block, queries in ((64, 8), (16, 3)):
        monkeypatch.setattr(pivots, "BLOCK", block)
        monkeypatch.setattr(pivots, "QUERIES", queries)
        found = pivots.top_k(table, F.col("vec_id") % 50 == 0).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == brute_force(rows, 5)
    assert pivots.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold_and_prune(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=4) + 20 * (i % 4 == 0)]) for i in range(4000)]
    vectors = pivots.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 256)
    centres = pivots.fit_pivots(vectors, 8, 500)
    index = pivots.blocks(pivots.keyed(vectors, centres), 256, True).cache()
    groups = pivots.blocks(pivots.keyed(vectors.where("vec_id % 400 = 0"), centres), 4, False).withColumnRenamed(
        "block", "group").cache()
    whole = {r["block"]: np.frombuffer(r["vectors"], "<i4").reshape(r["n"], -1) for r in index.collect()}
    asked = {r["group"]: np.frombuffer(r["vectors"], "<i4").reshape(r["n"], -1) for r in groups.collect()}
    tiles = pivots.bounds(groups, index, centres).collect()
    assert len(tiles) == len(whole) * len(asked)
    best = {g: max((asked[g].astype(int) @ w.T).max() for w in whole.values()) for g in asked}
    for t in tiles:
        assert (asked[t["group"]].astype(int) @ whole[t["block"]].T).max() <= t["bound"]
    assert any(t["bound"] < best[t["group"]] for t in tiles)


@pytest.mark.parametrize("power", [4, 15, 20, 25])
@pytest.mark.parametrize("dim", [2, 64])
def test_bounds_never_fall_below_the_product(power, dim):
    """Vectors near a pivot, with components up to 2**25: exact products in whole numbers."""
    rng = np.random.default_rng(power)
    pivot = rng.uniform(-1, 1, dim) * 2.0**power
    for spread in (1e-7, 1e-3, 1.0):
        x, q = (np.rint(pivot + rng.normal(size=(400, dim)) * spread * 2.0**power).clip(-(2.0**26) + 1, 2.0**26 - 1) for _ in range(2))
        gx, gq = (pivots.distances(v, pivot[None])[:, 0] for v in (x, q))
        nx, nq = (np.sqrt((v**2).sum(1)) for v in (x, q))
        bound = pivots.upper_bound(gq, gq, gx, gx, nq, nx)
        product = [sum(int(a) * int(b) for a, b in zip(u, v)) for u, v in zip(q, x)]
        assert all(b >= p for b, p in zip(bound, product))


def test_share_of_tiles_left_out(spark):
    """Clustered vectors: most blocks are ruled out for a group of queries from one cluster."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16)) * 3
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=16) * 0.1]) for i in range(6000)]
    vectors = pivots.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 256)
    found = pivots.fit_pivots(vectors, 12, 1000)
    index = pivots.blocks(pivots.keyed(vectors, found), 128, True).cache()
    groups = pivots.blocks(pivots.keyed(vectors.where("vec_id % 12 = 0 AND vec_id % 50 = 0"), found), 16, False).withColumnRenamed(
        "block", "group").cache()
    whole = np.array([[int(np.floor(x * 256)) for x in v] for _, v in rows])
    floor = {r["group"]: min(np.sort(np.frombuffer(r["vectors"], "<i4").reshape(r["n"], -1).astype(int) @ whole.T, axis=1)[:, -6])
             for r in groups.collect()}
    tiles = pivots.bounds(groups, index, found).collect()
    assert sum(t["bound"] < floor[t["group"]] for t in tiles) > 0.8 * len(tiles)


PAGE = """<html><head><title>T</title></head><body><div id="cookie-notice"><p>We use cookies here. Accept?</p></div>
<header><h1>Site</h1></header><ul class="menu"><li><a href=x>Home</a><li><a href=y>News</a></ul><div class="post-content">
<h2>A title</h2><p>First long  paragraph of the text,<br>with <a href=q>one link</a> in it.&nbsp;Fine &lt;b&gt;.</p>
<script>var t = "</p>";</script><ul><li>Point one</li><li>Point two</li></ul><aside>Related: <a>foo</a></aside>
<div class="ad-slot">Buy now! It is really good.</div><p>Last paragraph, quite long as well, to be sure.</p></div>
<form><label>Name</label><button>Send</button></form><section class="comments"><p>Great article, I liked it a lot!</p></section>
<footer><p>&copy; 2024 Site.</p></footer></body>"""
WANT = ("A title\nFirst long paragraph of the text, with one link in it. Fine <b>.\nPoint one\nPoint two\n"
        "Last paragraph, quite long as well, to be sure.")


def test_extraction(spark):
    article = "<nav><a>x</a></nav><article><h1>Head</h1><p>Body &amp; more.<p>Second <b>one.</article><footer>f</footer>"
    html = [PAGE, article, None, "", "<p", "<!-- x", "<nav>only menu</nav>", PAGE, "<div>" * 3000 + "deep" + "</i>" * 3000]
    table = spark.createDataFrame([(i, "u", h, "clash") for i, h in enumerate(html)],
                                  "page_id long, url string, html string, text string")
    rows = {r["page_id"]: r for r in extract.extracted(table).collect()}
    assert rows[0]["text"] == rows[7]["text"] == WANT
    assert rows[1]["text"] == "Head\nBody & more.\nSecond one."
    assert all(rows[i]["text"] == "" and rows[i]["n_chars"] == 0 for i in range(2, 7))
    assert rows[0]["n_chars"] == len(WANT)
    assert extract.extracted(table.limit(0)).count() == 0


def test_cut_is_minimal():
    pick = random.Random(9)
    for _ in range(200):
        n = pick.randint(1, 8)
        lean = np.array([pick.uniform(-3, 3) for _ in range(n)])
        edges = [(i, j, pick.uniform(0, 2)) for i in range(n) for j in range(i + 1, n) if pick.random() < 0.5]

        def cost(side):
            own = sum(max(-x, 0) if s else max(x, 0) for x, s in zip(lean, side))
            return own + sum(c for i, j, c in edges if side[i] != side[j])

        best = min(cost([m >> k & 1 for k in range(n)]) for m in range(1 << n))
        assert cost(extract.minimum_cut(lean, edges)) == pytest.approx(best)
