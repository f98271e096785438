"""Archives, URL filters, components and nearest neighbours against brute force."""

import gzip
import hashlib
import io
import random

import numpy as np
import pytest

from ragstone.llm import ann, components, url_filter, warc

PAGES = "page_id long, url string, html string, verdict string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"https://h{i}.example.org/{i}", f"<p>{i % 7}</p>" * 200) for i in range(40)]
    rows += [(100, None, None), (101, "http://x/", ""), (102, "http://x/", "short"), (103, "http://x/", "short"), (40, "u", "Ω" * 300_000), (41, "u", "Ω" * 300_000)]
    return spark.createDataFrame([(*r, "clash") for r in rows], PAGES).repartition(3)


def test_archives_round_trip(spark, pages):
    rows = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    held = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert rows.keys() == held.keys()
    for i, r in rows.items():
        first = max(k for k, v in held.items() if v == held[i])
        revisit = len(held[i]) >= 1000 and first != i
        assert (r.payload_bytes, r.payload_digest) == (len(held[i]), hashlib.sha1(held[i]).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_ranges_own_each_record_once(spark, pages, size):
    manifest = warc.write_archives(pages)
    assert manifest.count() >= 1
    if size >= 1000:
        assert sorted(r.page_id for r in warc.read_archives(manifest, size).collect()) == sorted(r.page_id for r in pages.collect())


class _File(io.BytesIO):
    pass


@pytest.mark.parametrize("size", [1, 13, 500, 10**6])
def test_reader_passes_over_false_magic(size):
    rng = random.Random(0)
    members = [warc.record(i, "u", "".join(rng.choice("ab\x1f\x8b\x08") for _ in range(rng.randint(0, 900))), "d", None) for i in range(20)]
    data = b"\x1f\x8b\x08junk" + b"".join(m + (b"\x1f\x8b\x08" if i % 5 == 0 else b"") for i, m in enumerate(members))
    found = [warc.parsed(x)["page_id"] for at in range(0, len(data), size) for x in warc.members(_File(data), at, at + size)]
    assert found == list(range(20))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)] + [(900, 900 + i) for i in range(80)] + [(7000, 7000), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges[:-1]:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_url_filter(spark):
    link = '<link href="{}" rel=canonical>'
    rows = [
        (1, "https://a.test/x", link.format("https://b.net/es/1")),  # alias of a blocked url
        (2, "https://c.test/q#f", '<meta http-equiv="refresh" content="0; url=https://a.test/x">'),  # over two edges
        (3, "https://shop.com/p", link.format("https://a.test/x")),  # explicit allow stands
        (4, "https://WWW.Example.com/en/5?q#z", None),
        (5, "http://m.example.com/en/", ""),
        (6, "http://m.example.com", ""),
        (7, None, None),
        (8, "no scheme", link.format("https://b.net/es/1")),
        (9, "https://d.test/dir/one", link.format("two")),
        (10, "https://d.test/dir/two", link.format("//b.net/fr/")),
        (11, "https://other.test/", link.format("/same")),
        (11, "https://other.test/", link.format("/same")),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    got = [(r.page_id, r.host, r.rule, r.verdict) for r in url_filter.judge_urls(pages).orderBy("page_id").collect()]
    assert got == [
        (1, "a.test", None, "block"),
        (2, "c.test", None, "block"),
        (3, "shop.com", "com/", "allow"),
        (4, "www.example.com", "www.example.com/en/", "allow"),
        (5, "m.example.com", "example.com/en/", "block"),
        (6, "m.example.com", None, "allow"),
        (7, "", None, "allow"),
        (8, "", None, "allow"),
        (9, "d.test", None, "block"),
        (10, "d.test", None, "block"),
        (11, "other.test", None, "allow"),
        (11, "other.test", None, "allow"),
    ]
    many = url_filter.RULES + [(f"h{i}.zz", "/", "block") for i in range(url_filter.INLINE_RULES)]
    again = [(r.page_id, r.host, r.rule, r.verdict) for r in url_filter.judge_urls(pages, many).orderBy("page_id").collect()]
    assert again == got
    redirects = spark.createDataFrame([("http://m.example.com/en/", "https://other.test/")], "from_url string, to_url string")
    assert {r.verdict for r in url_filter.judge_urls(pages, redirects=redirects).filter("page_id = 11").collect()} == {"block"}
    assert url_filter.judge_urls(spark.createDataFrame([], PAGES)).count() == 0


def test_link_edges_of_quoted_targets_and_rel_tokens(spark):
    to = "https://b.net/es/1"
    tags = [
        f"""<meta http-equiv="refresh" content="0; url='{to}'">""",
        f"""<meta http-equiv=refresh content='0; URL = "{to}"'>""",
        f'<link rel="alternate canonical" href="{to}">',
        f"<link rel='canonical\tnofollow' href='{to}'>",
        f'<link href="{to}" rel=CANONICAL>',
        f'<link rel=canonical href="{to}"/>',
    ]
    others = [f'<link rel="not-canonical" href="{to}">', f'<link data-rel="canonical" rel="icon" href="{to}">', f'<link rel="canonical-old" href="{to}">']
    pages = spark.createDataFrame([(i, f"https://a.test/{i}", x, None) for i, x in enumerate(tags + others)], PAGES)
    assert {r.u: r.v for r in url_filter.link_edges(pages).collect()} == {f"https://a.test/{i}": to for i in range(len(tags))}
    assert {r.page_id for r in url_filter.judge_urls(pages).filter("verdict = 'block'").collect()} == set(range(len(tags)))


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 16, size=(2000, 3), dtype=np.uint16)
    index = ann.MultiIndex(codes)
    for radius in (0, 3, 10, 17, 22, 48):
        q = codes[5] ^ np.uint16(3)
        far = np.unpackbits((codes ^ q).view(np.uint8), axis=1).sum(1)
        assert np.array_equal(index.within(q, radius), np.flatnonzero(far <= radius))


def test_nearest(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(900, 24)).astype("f4")
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [(2000, None, "x"), (2020, [0.0] * 24, "x"), (2040, [float("nan")] * 24, "x"), (2060, [1.0, None] * 12, "x"), (None, [1.0] * 24, "x"), (20, vectors[20].tolist(), "x")]
    schema = "vec_id long, embedding array<float>, score string"
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, schema)).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert sorted(got) == list(range(0, 900, 20))
    exact, hits = vectors.astype("f8"), 0
    for q, found in got.items():
        score = exact @ exact[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(900), -score))[:20]
        assert sorted(found) == list(range(1, 21))
        assert all(np.isclose(s, score[v], atol=1e-12) for v, s in found.values())
        ordered = [found[k] for k in range(1, 21)]
        assert ordered == sorted(ordered, key=lambda x: (-x[1], x[0]))
        hits += len({v for v, _ in found.values()} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(got)
    few = ann.nearest(spark.createDataFrame(rows[:4], schema)).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, 1), (0, 2), (0, 3)]
    assert ann.nearest(spark.createDataFrame([], schema)).count() == 0


def test_rule_ties_do_not_depend_on_the_number_of_rules(spark):
    """The later of two rules of one length wins, inline and joined."""
    rows = spark.createDataFrame([(1, "http://a.b.com/a/x", "")], "page_id long, url string, html string")
    fill = [(f"h{i}.test", "/", "block") for i in range(url_filter.INLINE_RULES)]
    for pair in ([("b.com", "/a/", "allow"), ("a.b.com", "/", "block")], [("a.b.com", "/", "block"), ("b.com", "/a/", "allow")]):
        got = [url_filter.judge_urls(rows, rules).first().verdict for rules in (pair, pair + fill, fill + pair)]
        assert got == [pair[1][2]] * 3


def test_edges_resolve_targets(spark):
    tags = {"../c?x=1&amp;y=2": "https://a.test/c?x=1&y=2", "./d/": "https://a.test/b/d/", "?q=1": "https://a.test/b/p?q=1", "/x/../y": "https://a.test/y", "//B.test/z": "https://b.test/z", "#top": "https://a.test/b/p", "..": "https://a.test/"}
    for to, want in tags.items():
        rows = spark.createDataFrame([(1, "https://a.test/b/p", f'<link rel="canonical" href="{to}">')], "page_id long, url string, html string")
        assert [r.v for r in url_filter.link_edges(rows).collect()] == [want]


def test_blocks_spread_over_a_random_graph(spark):
    rng = random.Random(11)
    n = 120
    url = lambda i: f"https://h{i}.net/{'es' if i % 17 == 0 else 'x'}/{i}"
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(90)]
    rows = [(i, url(i), "".join(f"<link rel='canonical' href='{url(b)}'>" for a, b in edges if a == i)) for i in range(n)]
    blocked, grown = {i for i in range(n) if i % 17 == 0}, True
    while grown:
        more = {y for a, b in edges for x, y in ((a, b), (b, a)) if x in blocked} - blocked
        blocked, grown = blocked | more, bool(more)
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).filter("verdict = 'block'").collect()
    assert {r.page_id for r in got} == blocked


def test_archives_by_other_writers():
    """Other header names' case and order, no length of the payload, no digest, further record types."""
    member = lambda head, body: gzip.compress("\r\n".join(["WARC/1.0", *head, f"content-length: {len(body)}"]).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")
    info = member(["WARC-Record-ID: <urn:uuid:1>", "WARC-Type: warcinfo", "Content-Type: application/warc-fields"], b"software: x")
    page = member(["Content-Type: application/http; msgtype=response", "warc-type: response", "WARC-Record-ID: <urn:uuid:2>"], b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nhello")
    headless = gzip.compress(b"WARC/1.0\r\nno fields\r\n\r\n")
    data = info + headless + page
    rows = [warc.parsed(x) for x in warc.members(_File(data), 0, len(data))]
    assert [(r["record_type"], r["payload"], r["payload_bytes"], r["page_id"]) for r in rows] == [("warcinfo", b"software: x", 11, None), ("response", b"hello", 5, None)]
    assert rows[1]["payload_digest"] == hashlib.sha1(b"hello").hexdigest()


def test_a_task_for_each_span(spark, pages):
    manifest = warc.write_archives(pages.repartition(3))
    spans = sum(-(-r.bytes // 1000) for r in manifest.collect())
    assert warc.read_archives(manifest, 1000).rdd.getNumPartitions() == spans
