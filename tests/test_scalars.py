"""Column functions at their edges."""

import base64
import json

from pyspark.sql import functions as F

from ratelattice.functions import scalars as S


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v")).alias("o")).collect()]


def test_quarter_overflow(spark):
    stamps = ["2024-05-15 00:00:00", "2024-11-02 00:00:00"]
    at = lambda ahead, wrap=False: values(spark, lambda c: S.effective_title(c.cast("timestamp_ntz"), ahead, wrap), stamps)
    assert at(0) == ["Effective APR-JUN 2024 (Q2)", "Effective OCT-DEC 2024 (Q4)"]
    assert at(1) == ["Effective JUL-SEP 2024 (Q3)", "Effective JAN-MAR 2024 (JAN-MAR)"]
    assert at(1, True) == ["Effective JUL-SEP 2024 (Q3)", "Effective JAN-MAR 2025 (Q1)"]
    assert values(spark, S.month_range, [1, 2, 3, 4, 5, 0], "int") == ["JAN-MAR", "APR-JUN", "JUL-SEP", "OCT-DEC", "JAN-MAR", "JAN-MAR"]
    assert values(spark, lambda c: S.base_rates_title(c.cast("timestamp_ntz")), ["2007-01-01 00:00:00"]) == ["BASE RATES FY07"]


def test_attachment_names(spark):
    names = ["a.pdf", "a.b.pdf", "x..pdf", "plain", "plain.", ".pdf", None, "a/./b.pdf", "./a\\b.pdf"]
    ts = F.lit("2024-05-15 10:20:33").cast("timestamp_ntz")
    assert values(spark, lambda c: S.stored_attachment_name(c, ts), names) == [
        "a_202405151020.pdf", "a_202405151020.b", None, None, None, "_202405151020.pdf", None, "a/b_202405151020.pdf", "a/b_202405151020.pdf",
    ]
    assert values(spark, S.attachment_error, names) == [None, None, "INVALID_PATH", "NO_EXTENSION", "NO_EXTENSION", None, "NO_EXTENSION", None, None]


def cookie(payload, pad=False):
    token = base64.urlsafe_b64encode(payload.encode()).decode()
    return "a|b|" + (token if pad else token.rstrip("="))


def test_cookie_user(spark):
    good = json.dumps({"id_token": {"user_name": "x"}})
    wide = json.dumps({"id_token": {"user_name": "ü??>>~~"}}, ensure_ascii=False)
    inputs = [cookie(good), cookie(good, True), cookie(wide), "a|b", "a|b|%%%", cookie("{"), cookie("{}"), None, cookie(good) + "|more"]
    assert values(spark, S.cookie_user, inputs) == ["x", "x", "ü??>>~~", None, None, None, None, None, "x"]
    errors = values(spark, S.cookie_error, inputs)
    assert [e is None for e in errors] == [True, True, True, False, False, False, False, False, True]


def test_labels_and_requests(spark):
    assert values(spark, S.strip_quotes, ['a"b"', "plain", '""']) == ["ab", "plain", ""]
    parsed = values(spark, S.rate_request, ['{"rate": 0.1, "note": "n"}', '{"rate"', '{"note": 5}'])
    assert [(r["rate"] and str(r["rate"]), r["note"]) for r in parsed] == [("0.1000", "n"), (None, None), (None, "5")]
    stamps = values(spark, S.parse_timestamp, ["2024-01-02 03:04:05", "2024-01-02T03:04:05", "nonsense"])
    assert [s and s.isoformat() for s in stamps] == ["2024-01-02T03:04:05", "2024-01-02T03:04:05", None]
