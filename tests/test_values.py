import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from corpus_engine.functions import status, text, values as v
from tests.helpers import column


def test_durations(spark):
    cases = {
        "PT3H7M11S": 11231, "PT59S": 59, None: None, "P": 0, "PT": 0, "P2DT5H": 190800, "P3W": None, "PT2.5S": None,
        "": None, "junk": None, "P99999999999999999999D": None, "P9223372036854775807D": None, "PT5M": 300,
    }
    assert column(spark, list(cases), "string", v.iso_duration_seconds) == list(cases.values())


def test_safe_int(spark):
    cases = {
        "12": 12, " 12 ": 12, "+5": 5, "-7": -7, "1_000": 1000, "_1": None, "1__0": None, "3.7": None, "": None,
        None: None, "1e3": None, "12345678901234567890": None, "\u00a042\u2003": 42, "n/a": None, "007": 7,
    }
    assert column(spark, list(cases), "string", v.safe_int) == list(cases.values())


# The first 20 hexadecimal digits of SHA-256 of "é|1|", "a|1|x" and "a|2|x".
DIGESTS = ["cc3aa03dd91c0b6a907e", "d740fcd4c1fa189d78c1", "564b231e7994111e6f76"]


def test_stable_id(spark):
    df = spark.createDataFrame([("é", 1, None), ("a", 1, "x"), ("a", 2, "x")], "a string, b int, c string")
    ids = [r[0] for r in df.select(v.stable_id(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert ids == DIGESTS
    assert len(set(ids)) == 3


def windows(spark, *args):
    rows = spark.range(1).select(F.explode(v.date_windows(*args)).alias("w")).select("w.*").collect()
    return [tuple(r) for r in rows]


def test_date_windows(spark):
    assert windows(spark, "2024-02-27", "2024-02-29", 14) == [("2024-02-27T00:00:00Z", "2024-03-01T00:00:00Z")]
    assert windows(spark, None, None, 30) == [(None, None)]
    assert windows(spark, "2026-01-01", "2026-01-04", 2) == [
        ("2026-01-01T00:00:00Z", "2026-01-03T00:00:00Z"), ("2026-01-03T00:00:00Z", "2026-01-05T00:00:00Z")]
    assert len(windows(spark, "2025-03-01", "2025-12-31", 45)) == 7
    for bad in (("2026-01-01", None, 30), ("2026-01-02", "2026-01-01", 30), ("2026-01-01", "2026-01-02", 0)):
        with pytest.raises(ValueError):
            v.date_windows(*bad)


def test_first_choices(spark):
    df = spark.createDataFrame(
        [("", "b"), (None, "b"), ("a", "b"), (None, ""), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(v.first_text(F.col("x"), F.col("y"))).collect()] == ["b", "b", "a", "", None]
    maps = spark.createDataFrame(
        [({}, {"url": "m"}), (None, {"url": "m"}), ({"width": "1"}, {"url": "m"}), ({"url": "h"}, None), (None, None)],
        "h map<string,string>, m map<string,string>")
    got = [r[0] for r in maps.select(v.first_object_field("url", F.col("h"), F.col("m"))).collect()]
    assert got == ["m", "m", None, "h", None]


def test_distinct_texts(spark):
    assert column(spark, [[" a ", "b", "a", "", "  ", "b\n"]], "array<string>", v.distinct_texts) == [["a", "b"]]


def test_clean_text(spark):
    cases = {"\u00a0a\u2003b\u2028c\u3000": "a b c", "  a \n\t b ": "a b", "a\u00a0\x1c\u2028b": "a b", " \x1f ": None, "": None, None: None, "x": "x"}
    assert column(spark, list(cases), "string", text.clean_text) == list(cases.values())


@settings(max_examples=5, deadline=None)
@given(hs.lists(hs.text(alphabet="ab \t\n\r\u00a0\u2003\x1c\x85é", max_size=12), min_size=20, max_size=40))
def test_clean_text_equals_split_and_join(spark, texts):
    assert column(spark, texts, "string", text.clean_text) == [" ".join(t.split()) or None for t in texts]


def test_language_helpers(spark):
    def choices(*languages):
        return spark.range(1).select(text.language_choices(languages)).first()[0]

    assert choices("de-AT", "fr", "de") == ["de-AT", "de", "fr"]
    assert choices("nl-BE") == ["nl-BE", "nl"] and choices("\t", None, "", " sv ") == ["sv"] and choices() == []
    spoken = column(spark, ["de-AT", "de-CH", "de", "den", "fr-CA", "(fr", "e.*", None], "string",
                    lambda c: text.speaks_one_of(c, ["de-AT", "fr", "e.*"]))
    assert spoken == [True, True, True, True, True, False, True, None]
    found = column(spark, ["x.DE-at.vtt", "x.de.vtt", "x.fr.vtt"], "string",
                   lambda c: text.language_in_name(c, ["de-AT"]))
    assert found == ["de-AT", "de", None]


VTT = (
    "WEBVTT - title\r\nKind: captions\r\n\r\nNOTE a remark\r\n\r\n1\r\n00:01.000 --> 00:02.000 align:start\r\n"
    "<c.yellow>Hello</c> <00:00:01.500>world\r\n\r\n2\r\n00:00:02,000 --> 00:00:03,000\r\n42\r\n  NOTE kept, it is indented\r\n"
    "tag <b\nsplit> end\u2028NOTE after a line separator"
)


def test_cue_text(spark):
    got = column(spark, [VTT, "1\n00:00:01.000 --> 00:00:02.000\n\n", "plain"], "string",
                 lambda c: text.cue_text(text.decode_file(F.encode(c, "UTF-8"))))
    assert got == ["Kind: captions Hello world NOTE kept, it is indented tag end", None, "plain"]


def test_header_goes_only_with_its_line_end(spark):
    assert column(spark, ["WEBVTT", "x\nWEBVTT\ny"], "string", text.cue_text) == ["WEBVTT", "x WEBVTT y"]


def test_latin1_file(spark):
    got = column(spark, ["olá não".encode("latin-1"), "olá não".encode()], "binary", text.decode_file)
    assert got == ["olá não", "olá não"]


def test_json3(spark):
    cases = {
        '{"events":[{"segs":[{"utf8":"a"},{"utf8":"\\n"},{"x":1}]},{"t":1},{"segs":[{"utf8":"b"}]}]}': "a b",
        '{"events":[]}': None, "{}": None, "not json": None,
    }
    assert column(spark, list(cases), "string", text.json3_text) == list(cases.values())


def test_outcomes(spark):
    rows = [
        ("403 commentsDisabled quota", 0, "comments_disabled"), ("videoNotFound", 3, "video_not_found"),
        ("quotaExceeded", 3, "quota_exceeded"), ("boom", 0, "error"), (None, 0, "no_comments"), (None, 2, "completed"),
    ]
    df = spark.createDataFrame(rows, "e string, n long, want string")
    for r in df.select(status.comment_outcome(F.col("e"), F.col("n")).alias("got"), "want").collect():
        assert r.got == r.want
    assert column(spark, ["dailyLimitExceeded", "QUOTA", "x", None], "string", status.is_quota_error) == [
        True, True, False, False]
