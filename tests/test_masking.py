import pytest
from pyspark.sql import functions as F

from clientlens.functions import masking


def _apply(spark, function, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(function(F.col("v"), **options)).collect()]


@pytest.mark.parametrize(
    ("function", "values", "expected"),
    [
        (
            masking.mask_name,
            ["Nguyen Van An", "Nguyen ****", "An", "", None],
            ["Nguyen ****", "Nguyen ****", "An ****", " ****", None],
        ),
        (
            masking.mask_phone,
            ["0912345901", "123456", "12345", None],
            ["091****901", "123****456", "12345", None],
        ),
        (
            masking.mask_email,
            ["user12@example.com", "@x.vn", "nobody", None],
            ["u***@example.com", "@***@x.vn", "nobody", None],
        ),
    ],
)
def test_masks(spark, function, values, expected):
    assert _apply(spark, function, values) == expected


def test_strict_masks_leave_nothing_readable(spark):
    assert _apply(spark, masking.mask_name, ["An", "Le An"], strict=True) == ["A ****", "Le ****"]
    assert _apply(spark, masking.mask_phone, ["12345", "123456"], strict=True) == ["*****", "******"]
    assert _apply(spark, masking.mask_email, ["nobody", None], strict=True) == ["***", None]


def test_token_is_sha256(spark):
    import hashlib

    assert _apply(spark, masking.hash_token, ["079"]) == [hashlib.sha256(b"079").hexdigest()]


def test_masking_twice_is_masking_once(spark):
    df = spark.createDataFrame([("Nguyen Van An",), ("An",)], "v string")
    once = df.select(masking.mask_name(F.col("v")).alias("v"))
    twice = once.select(masking.mask_name(F.col("v")).alias("v"))
    assert once.collect() == twice.collect()
