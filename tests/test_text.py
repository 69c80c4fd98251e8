import pytest
from pyspark.sql import functions as F

from quern.functions import text as X

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"


def py_clean(t, n):
    s = " ".join((t or "").split())
    if len(s) <= n:
        return s
    cut = s[:n]
    return cut.rsplit(" ", 1)[0].strip() if " " in cut else cut


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_clean_matches_python(spark):
    values = [None, "", "  ", "a b", f"x{SPACES}y", SPACES + "mid" + SPACES, "word " * 40, "nospace" * 40, "exact ten!", "cut on end here", "日本語 テキスト " * 5, "\U0001f600 smile " * 9]
    for n in (1, 10, 50):
        assert column(spark, values, lambda c: X.clean_text(c, n)) == [py_clean(v, n) for v in values]


@pytest.mark.parametrize("space", SPACES)
def test_every_space_counts(spark, space):
    assert column(spark, [f"{space}a{space}{space}b{space}"], X.squeeze) == ["a b"]


def test_as_text(spark):
    got = spark.sql("""select parse_json(j) v, i from values (1, 'null'), (2, '" a "'), (3, 'true'), (4, '12'), (5, '1.5'), (6, '[1]'), (7, '{"a":1}'), (8, null) t(i, j)""")
    assert [r[0] for r in got.orderBy("i").select(X.as_text("v")).collect()] == ["", "a", "True", "12", "1.5", "", "", ""]


def test_small_expressions(spark):
    assert column(spark, ["a b/c", "x", None, "ö.1-_"], X.slug) == ["a_b_c", "x", None, "_.1-_"]
    assert column(spark, [None, "", "abc", "é" * 10], X.estimate_tokens) == [1, 1, 1, 5]
    assert column(spark, ["hi<|channel>no<channel|> yes ", "plain"], X.strip_thinking) == ["hi yes", "plain"]
    assert column(spark, ["a/b.PNG", "x.wav", "none", None], X.mime_type) == ["image/png", "audio/x-wav", "application/octet-stream", "application/octet-stream"]
    assert column(spark, ["http://x", "data:a", "/p", "p"], X.media_url) == ["http://x", "data:a", "file:///p", "file:///p"]


def test_prompt_and_prefix(spark):
    df = spark.createDataFrame([("p", "c"), ("p", None), (None, "c"), ("same", "same"), (" ", "")], "p string, c string")
    assert [r[0] for r in df.select(X.build_prompt("p", "c", strict=False)).collect()] == ["c\n\np", "p", "c", "same\n\nsame", None]
    assert [r[0] for r in df.select(X.prefix_text("p", "c")).collect()] == ["c\n\np", "p", "c", "same", ""]
    with pytest.raises(Exception, match="neither prompt nor context"):
        df.select(X.build_prompt("p", "c")).collect()


def test_chat_content_has_text_then_image_data(spark):
    df = spark.createDataFrame([("look", {"images": ["a.png", ""], "audio": ["b.wav"]})], "p string, media map<string,array<string>>")
    parts = df.select(X.chat_content("p", "media")).first()[0]
    assert [p["type"] for p in parts] == ["text", "image_url", "audio_url"]
    url = spark.sql("select 'a.png' p, unhex('00ff') c").select(X.media_url("p", F.col("c"))).first()[0]
    assert url == "data:image/png;base64,AP8="
