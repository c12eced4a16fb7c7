import html

import pytest

from commentloom.functions import text as t


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column("x").alias("y")).first()[0]


CASES = [
    (t.unescape_html, "&eacute;&#39;&ltb &amp;lt; &amp", "é'<b &lt; &"),
    (t.unescape_html_basic, "&lt;a&gt;&nbsp;&amp;lt;", "<a> &lt;"),
    (t.strip_tags, "a<b c='1'>d</b>e < f", "ade < f"),
    (t.flatten_lines, "a\r\n\tb\nc", "a b c"),
    (t.unlink_markdown, "[x y](http://a.b) and [no] (z)", "x y and [no] (z)"),
    (t.strip_user_mentions, "hi /u/some-one_1, you/abc u/x", "hi , yo "),
    (t.strip_zero_width, "a​b‌c‍d", "abcd"),
    (t.strip_urls, "see http://a.b/c?d=e f www.x.y z", "see  f  z"),
    (t.strip_emails, "to a.b+c@d.example.org, ok@no", "to , ok@no"),
    (t.strip_phones, "call +1 (017) 555-7713 or 9876543210 or 123 45", "call  or  or 123 45"),
    (t.fix_unicode, "café ok", "café ok"),
    (t.squash_whitespace, "  a   b\tc  d\x1c", "a b\tc d"),
    (lambda c: t.squash_whitespace(c, 1), "a\tb c", "a b c"),
    (t.dedup_key, "Hé, YOU_2!", "hyou2"),
    (t.dedup_key, "नमस्ते", ""),
    (t.tokenize, "abc cliché na_ve foo_bar 10² X9", ["abc", "x9"]),
    (t.tokenize_alpha, "ab abc1 abc Trés foo_bar done", ["abc", "done"]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_column(spark, case):
    column, value, want = CASES[case]
    assert one(spark, column, value) == want


def test_unescape_equals_library(spark):
    values = ["&notit; &copy &#x1F600; &#0; plain", None, "&&amp;amp;", "a & b"]
    got = [one(spark, t.unescape_html, x) for x in values]
    assert got == [x if x is None else html.unescape(x) for x in values]


def test_profiles(spark):
    raw = "&lt;i&gt;Hi&lt;/i&gt; /u/me\n[site](http://a.b) at www.x.y, m@n.org  +91 98765-43210​"
    df = spark.createDataFrame([(raw,), (None,)], "body string")

    def clean(p):
        return [r[0] for r in t.sanitize(df, p).select("body_clean").collect()]

    assert clean("worker") == ["Hi site at", ""]
    assert clean("harvester") == ["Hi [site](<URL> at <URL> <EMAIL> +91 98765-43210​", ""]
    assert clean("notebook") == [
        "<i>Hi</i> /u/me site at m@n.org +91 98765-43210", ""
    ]
    with pytest.raises(KeyError):
        t.sanitize(df, "other")


def test_cleaning_stays_linear(spark):
    """The chain must not multiply its input expression."""
    df = t.sanitize(spark.createDataFrame([("a",)], "body string"), "worker")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") < 20


def shown(text, layers, codec):
    """``layers`` readings of UTF-8 bytes by Python's codecs; windows-1252 shows unassigned bytes as controls."""
    for _ in range(layers):
        raw = text.encode()
        text = "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in raw)
    return text


CLEAN = ["café", "naïve Où Élan", "GRÖSSE", "日本語 text", "emoji 😀🏳️‍🌈", "“quotes” – dash…", "plain", "Привет мир", "नमस्ते", "½ £5 §", "ßÄÖÜ end", "a\nÉ\tb ", "", "x" * 5000 + "é"]
UNTOUCHED = [*CLEAN, "IRMÃ… foi", "CAFÉ™", "Ã", "â", "Ã©\ud7ff"[:1], "Škoda řeka", "Â", "ÇÃ…"]


@pytest.mark.parametrize("codec", ["latin-1", "cp1252"])
@pytest.mark.parametrize("layers", [1, 2, 3])
def test_misread_texts_are_repaired(spark, codec, layers):
    data = [(x, shown(x, layers, codec)) for x in CLEAN]
    df = spark.createDataFrame([*data, (None, None)], "want string, x string")
    for r in df.select("want", t.repair_mojibake("x").alias("got")).collect():
        assert r["got"] == r["want"]
    damage = df.select("x", t.misread("want", layers).alias("y")).collect()
    assert codec != "cp1252" or all(r["x"] == r["y"] for r in damage)


def test_clean_texts_are_left_alone(spark):
    df = spark.createDataFrame([(x,) for x in UNTOUCHED], "x string")
    assert [r["y"] for r in df.select(t.repair_mojibake("x").alias("y")).collect()] == UNTOUCHED
    mixed = "é stays, " + shown("é", 2, "cp1252") + " goes, 日本 " + shown("日本", 1, "cp1252")
    assert spark.createDataFrame([(mixed,)], "x string").select(t.repair_mojibake("x")).first()[0] == "é stays, é goes, 日本 日本"


def test_profiles_repair_on_request(spark):
    df = spark.createDataFrame([("1", "<b>cafÃ©</b> &amp; x"), ("2", None)], "id string, body string")
    for profile in ("worker", "harvester"):
        for repair, want in ((True, "café & x"), (False, "cafÃ© & x")):
            got = {r["id"]: r["body_clean"] for r in t.sanitize(df, profile, repair=repair).collect()}
            assert got == {"1": want, "2": ""}


def test_what_may_be_meant_goes_beside_sure_damage(spark):
    data = [("IRMÃ… foi", "IRMÃ… foi"), ("IRMÃ… foi cafÃ©", "IRMÅ foi café")]
    df = spark.createDataFrame(data, "x string, want string").select("want", t.repair_mojibake("x").alias("got"))
    assert all(r["want"] == r["got"] for r in df.collect())


def test_mojibake_repair_stays_in_the_jvm(spark):
    from conftest import plan_of

    df = spark.createDataFrame([("a",)], "x string").select(t.repair_mojibake("x").alias("y"))
    assert "Python" not in plan_of(df)


def test_filters_on_raw_columns_pass_the_cleaning(spark):
    """They reach the scan; a filter on the cleaned text does not, and cleans nothing twice."""
    from conftest import plan_of

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    clean = t.sanitize(docs, "worker", "text")
    plan = plan_of(clean.filter("doc_id > 150 AND source = 'src1' AND length(body_clean) > 3"))
    assert "GreaterThan(doc_id,150)" in plan and "EqualTo(source,src1)" in plan
    assert plan.count("ArrowEvalPython") == plan_of(clean).count("ArrowEvalPython")
    want = sorted(r["doc_id"] for r in clean.collect() if r["doc_id"] > 150 and len(r["body_clean"]) > 500)
    assert sorted(r["doc_id"] for r in clean.filter("doc_id > 150 AND length(body_clean) > 500").collect()) == want
    same = t.sanitize(docs, "notebook", "text", "text")
    assert same.columns == docs.columns


def test_entities_are_decoded_once(spark):
    """Steps after the decoding read its column; the plan has one call of the Python function for it."""
    from conftest import plan_of

    df = spark.createDataFrame([("a &amp; b",)], "body string")
    for profile in ("worker", "harvester"):
        plan = plan_of(t.sanitize(df, profile))
        calls = [line for line in plan.splitlines() if "EvalPython" in line]
        assert sum(line.split("],")[0].count("_decode_entities(") for line in calls) == 1, plan


def test_python_sees_pieces_only(spark):
    """Same results as on whole texts, of all characters that NFC changes and of references of all kinds."""
    import html
    import random
    import unicodedata

    points = [p for p in range(0xA0, 0x110000) if not 0xD800 <= p < 0xE000]
    odd = [chr(p) for p in points if unicodedata.normalize("NFC", chr(p)) != chr(p) or unicodedata.combining(chr(p))]
    rng = random.Random(3)
    marks = [c for c in odd if unicodedata.combining(c)] + list("\u1161\u11a8\u09be\u0b3e\u0dcf\U000114ba")
    base = list("aeo \u1100\uac00\u0915\u09c7\u0b47\u0dd9\U000114b9\u00e9") + ["x&amp", "&#769;", "&eacute;"]
    texts = ["".join(odd[i : i + 40]) for i in range(0, len(odd), 40)] + ["".join("a" + c for c in marks)]
    texts += ["".join(rng.choice(base + marks) for _ in range(rng.randrange(25))) for _ in range(600)]
    refs = ["&", "&amp", "&amp;lt;", "&ampx", "&notin;", "&notit;", "&#0;", "&#x80;", "&#xD800;", "&#1114112;", "&#X41", "&#65", "&;", "&\U0001f600" * 3,
            "&" + "\U0001f600" * 40, "& ", "&\n", "&a&b;", "&#", "&#x", "<", ";", "x", "&#1;", "&NotEqualTilde;"]
    texts += ["".join(rng.choice(refs) for _ in range(rng.randrange(12))) for _ in range(400)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, s string")
    got = df.select("id", t.fix_unicode("s").alias("n"), t.unescape_html("s").alias("h")).collect()
    for i, n, h in got:
        s = texts[i]
        assert n == (s and unicodedata.normalize("NFC", s)), ascii(s)
        assert h == (s and html.unescape(s)), ascii(s)
