"""Column functions against the standard library and published vectors."""

import re
from urllib.parse import parse_qs, unquote

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logharrow.config import Url
from logharrow.functions import agents, segments, url
from logharrow.functions.hashing import murmur3, token_vector


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_endpoint_group(spark):
    cases = {"/App/Page.ASPX": "/app/page.aspx", "/app/": "/app", "/": "/", "//": "", "/a/123/b": "/a/{num}/b", "/a/123": "/a/{num}", "/a%20B/7/": "/a b/{num}", "/a/12b": "/a/12b", "/x+y%2": "/x+y%2"}
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", url.endpoint_group(F.col("x")).alias("y"))
    assert {r.x: r.y for r in df.collect()} == cases


def test_aggressive_templates(spark):
    f = lambda c: url.endpoint_group(c, Url(aggressive_template=True))
    assert one(spark, "/d/0F8FAD5B-D9CB-469F-A165-70867728950E/x", f) == "/d/{guid}/x"
    assert one(spark, "/d/0123456789abcdef0", f) == "/d/{hex}"


def test_extension_and_path(spark):
    for stem, want in {"/a/b.ASPX": "aspx", "/a.b/c": None, "/a": None, "/a.": "", "/x.ashx?y=1.z": "ashx", "/p%2Easpx": "aspx"}.items():
        assert one(spark, stem, url.extension) == want
    assert one(spark, "/a/b/c/", url.path_depth) == 3
    assert one(spark, "/", url.path_depth) == 0
    assert one(spark, "/a//B", url.path_tokens) == ["a", "", "b"]


TEXT = st.text(alphabet="ab01%&=+.-_?é /2F", max_size=25)


@settings(max_examples=20, deadline=None)
@given(st.lists(TEXT, min_size=20, max_size=40))
def test_url_functions_like_the_standard_library(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    df = df.select("i", url.decode(F.col("x")).alias("d"), url.query_stats(F.col("x")).alias("q"))
    for r in df.collect():
        text = texts[r.i]
        if "�" in unquote(text):
            continue  # escapes of invalid UTF-8
        assert r.d == unquote(text)
        blank = not text or text == "-"
        parsed = {} if blank else parse_qs(unquote(text), keep_blank_values=True)
        values = [v for vs in parsed.values() for v in vs]
        if any("�" in v for v in [*values, *parsed]):
            continue
        assert r.q.key_set == sorted(parsed)
        assert (r.q.key_count, r.q.value_count, r.q.max_value_len) == (len(parsed), len(values), max(map(len, values), default=0))
        assert r.q.decoded_len == (0 if blank else len(unquote(text)))


def test_query_of_null_and_dash(spark):
    for q in (None, "-", ""):
        got = one(spark, q, url.query_stats)
        assert (got.key_set, got.key_count, got.value_count, got.mean_value_len, got.special_char_ratio, got.decoded_len) == ([], 0, 0, 0.0, 0.0, 0)
    assert one(spark, "a=<script>", url.query_stats).special_char_ratio > 0


def test_murmur_vectors():
    for data, seed, want in ((b"", 0, 0), (b"", 1, 0x514E28B7), (b"\xff\xff\xff\xff", 0, 0x76293B50), (b"!Ce\x87", 0, 0xF55B516B), (b"test", 0x9747B28C, 0x704B81DC), (b"Hello, world!", 0x9747B28C, 0x24884CBA), (b"aaa", 0x9747B28C, 0x283E0130)):
        assert murmur3(data, seed) == want


def test_murmur3_of_many():
    from logharrow.functions.hashing import murmur3_many, token_vectors

    texts = [b"", b"a", b"ab", b"abc", b"abcd", b"abcde", "größe".encode(), b"x" * 37, b"a"]
    assert [murmur3_many(texts, seed).tolist() for seed in (42, 43)] == [[murmur3(t, seed) for t in texts] for seed in (42, 43)]
    many = token_vectors([["a", None, "b"], None, [], ["b", "b"]], 16)
    assert (many[0] == token_vector(["a", "b"], 16)).all() and not many[1].any() and not many[2].any() and (many[3] == 2 * token_vector(["b"], 16)).all()


def test_token_vector():
    v = token_vector(["a", "b", "a"], 16)
    assert v.shape == (16,) and abs(v).sum() in (1, 3) and (token_vector([], 8) == 0).all()
    assert (token_vector(["a", "a"], 16) == 2 * token_vector(["a"], 16)).all()


def test_segments(spark):
    df = spark.createDataFrame([(200, "2xx"), (302, "3xx"), (404, "4xx"), (599, "5xx"), (100, "unknown"), (600, "unknown"), (None, "unknown")], "s int, w string")
    assert all(r.c == r.w for r in df.select("w", segments.status_class(F.col("s")).alias("c")).collect())
    seg = spark.range(1).select(segments.segment_id(segments.segment_key(F.lit("/a"), F.lit("get"), F.lit("2xx"), F.lit(0))).alias("x")).first().x
    assert seg == f"seg_{murmur3(b'/a|GET|2xx|0'):08x}" and re.fullmatch("seg_[0-9a-f]{8}", seg)
    assert spark.range(1).select(segments.parent_segment_id(F.lit("/a"), F.lit("get"))).first()[0].startswith("pseg_")
    assert spark.range(1).select(segments.segment_key(F.lit("/a"), F.lit("GET"), F.lit("2xx"), F.lit(0), F.lit("H"))).first()[0] == "/a|GET|2xx|0|h"
    triple = segments.status_triple(F.lit(404), F.lit(None), F.lit(2))
    assert spark.range(1).select(triple, segments.status_hash(triple)).first() == ("404_0_2", murmur3(b"404_0_2") % 1000)


def test_agents(spark):
    bots = {"Mozilla/5.0 (compatible; Googlebot/2.1)": True, "curl/7.68": True, "Mozilla/5.0 (Windows NT 10.0)": False, "-": False, "": False, None: False, "PYTHON-REQUESTS/2": True}
    assert all(one(spark, k, agents.is_bot) == v for k, v in bots.items())
    ua = one(spark, "Mozilla/5.0+(Windows+NT+10.0;+Win64)+AppleWebKit/537.36+Chrome/120.0.0.0+Safari/537.36", agents.parse_agent)
    assert (ua.browser_family, ua.browser_version, ua.os_family, ua.os_version, ua.bot_flag) == ("Chrome", "120", "Windows", "10", 0)
    assert one(spark, "-", agents.parse_agent).browser_family == "Other"


def test_ordered_bits(spark):
    """The stored bits for numbers above 0, the same order for all, and the way back; all powers of two and their neighbours."""
    import numpy as np
    from pyspark.sql import functions as F

    from logharrow.functions.bits import from_ordered_bits, ordered_bits

    powers = 2.0 ** np.arange(-1074, 1024)
    rng = np.random.default_rng(5)
    x = np.concatenate([powers, np.nextafter(powers, 0), np.nextafter(powers[:-1], np.inf), rng.random(500), np.exp(rng.normal(0, 200, 500)), [np.inf, 1.7976931348623157e308, 0.0]])
    x = np.concatenate([x, -x])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    rows = df.select("x", ordered_bits(F.col("x")).alias("b")).select("x", "b", from_ordered_bits(F.col("b")).alias("y")).collect()
    for r in rows:
        if r.x is None:
            assert r.b is None and r.y is None
        elif r.x != r.x:
            assert r.y != r.y and r.b > max(q.b for q in rows if q.x == q.x and q.x is not None)
        else:
            assert r.y == r.x and r.b == (int(np.float64(r.x).view(np.int64)) if r.x > 0 else 0 if r.x == 0 else -1 - int(np.float64(-r.x).view(np.int64)))
