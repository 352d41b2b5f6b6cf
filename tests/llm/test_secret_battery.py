"""The three tests and the limits against the same arithmetic in Python, and where candidates begin."""

import math
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from ledgertag.llm import secret_scan

RNG = random.Random(11)
LETTERS = {name: letters for name, _, letters in secret_scan.ENCODINGS}


def code(n, letters=string.ascii_letters + string.digits):
    return "".join(RNG.choice(letters) for _ in range(n))


def scanned(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    column = F.col(f"{secret_scan.OWN}candidates").alias("candidates")
    return secret_scan._scanned(frame).select("doc_id", column)


def tail(z):
    power = 1.5976 * z + 0.070566 * z**3
    return max(1 / (1 + math.exp(power)), 1e-12) if power < 700 else 1e-12


def probability(value):
    """Chi-squared, runs and serial correlation of one string, joined by Fisher's rule."""
    name = next(n for n, pattern, _ in secret_scan.ENCODINGS if re.match(pattern, value))
    letters = LETTERS[name]
    size, n = len(letters), len(value)
    codes = [letters.index(c) for c in value]
    expected = n / size
    chi = sum((codes.count(k) - expected) ** 2 / expected for k in range(size))
    middle = (size - 1) / 2
    above = [c > middle for c in codes]
    turns = sum(a != b for a, b in zip(above, above[1:], strict=False))
    products = sum((a - middle) * (b - middle) for a, b in zip(codes, codes[1:], strict=False))
    z = (
        (chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n),
        abs(turns - (n - 1) / 2) / math.sqrt((n - 1) / 4),
        abs(products) / (math.sqrt(n - 1) * (size**2 - 1) / 12),
    )
    half = max(-(math.log(tail(z[0])) + math.log(2 * tail(z[1])) + math.log(2 * tail(z[2]))), 0)
    return f"{name}:{int(math.log2(n))}", math.exp(-half) * (1 + half + half * half / 2)


def test_statistics_equal_plain_arithmetic(spark):
    values = [code(n) for n in (20, 33, 64, 200)] + [
        code(40, "0123456789abcdef"), code(40, LETTERS["base32"]), code(48, LETTERS["base64"]), "a1B" * 12,
        "thisIsALongIdentifierName3", code(30, string.ascii_letters), "Ab" + code(60, LETTERS["base64url"]) + "9",
    ]
    found = {r.doc_id: r.candidates for r in scanned(spark, values).collect()}
    for i, value in enumerate(values):
        ((start, end, stratum, p),) = found[i]
        assert (start, end) == (0, len(value))
        wanted = probability(value)
        assert stratum == wanted[0] and p == pytest.approx(wanted[1], rel=1e-9)


def test_limits_equal_plain_counting(spark):
    def rows(stratum, ps):
        return [(stratum, p) for p in ps]

    mixed = [RNG.random() for _ in range(400)] + [RNG.random() ** 8 * 0.2 for _ in range(300)]
    data = rows("mixed:5", mixed) + rows("words:5", [0.001 * i / 60 for i in range(60)]) + rows("few:5", [0.5, 0.01])
    data += rows("keys:5", [RNG.random() for _ in range(200)]) + rows("few:4", [0.3])
    frame = spark.createDataFrame([([x],) for x in data], "candidates array<struct<stratum:string,p:double>>")
    found = secret_scan.limits(frame)

    def plain(ps):
        steps = [min(int(p * 200), 199) for p in ps]
        half = sum(s >= 100 for s in steps)
        random_ones = 2 * (half + half**0.5)
        for at in range(1, 101):
            passed = sum(s >= at for s in steps)
            if passed and passed - random_ones * (1 - at / 200) <= 0.1 * passed:
                return at / 200
        return None

    by_stratum = {}
    for stratum, p in data:
        by_stratum.setdefault(stratum, []).append(p)
    fixed = {"few:5": 0.005, "few:4": 0.1}
    wanted = {s: fixed[s] if len(ps) < 50 else plain(ps) for s, ps in by_stratum.items()}
    assert found == {s: limit for s, limit in wanted.items() if limit is not None}
    assert "words:5" not in found and found["keys:5"] < found["mixed:5"]


@pytest.mark.parametrize("frame", ["hooks/team-x/{}", "my_key/{} ", "{}/a-b_c", "pre-fix/{}_suffix/x-y"])
def test_glued_secrets_are_found(spark, frame):
    keys = [code(40) for _ in range(40)]
    docs = spark.createDataFrame([(i, f"w {frame.format(k)}.") for i, k in enumerate(keys)], "doc_id long, text string")
    found = {r.doc_id: r.spans_text for r in secret_scan.scan(docs).collect()}
    start = 2 + frame.index("{")
    assert sum(found[i] == f"random:{start}:{start + 40}" for i in range(40)) >= 36
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert sum(clean[i] == f"w {frame.format(secret_scan.MARK)}." for i in range(40)) >= 36


def test_parts_keep_the_widest_encoding_that_fits(spark):
    key = "Ab3+" * 4 + "/Zq9" + "x1Y/" * 3
    texts = [f"one-{key}-two_three", "some/long_path/without-any_digits/atAll/here", "/" * 30, code(24, string.ascii_letters)]
    found = {r.doc_id: [(c.start, c.end, c.stratum.split(":")[0]) for c in r.candidates] for r in scanned(spark, texts).collect()}
    assert found[0] == [(4, 4 + len(key), "base64")]
    assert found[1] == [] and found[2] == []
    assert found[3] == [(0, 24, "letters")]


def test_long_lists_take_a_time_that_grows_with_them(spark):
    hashes = " ".join(code(32, "0123456789abcdef") for _ in range(20_000))
    docs = spark.createDataFrame([(1, f"{hashes} password=abcdefgh")], "doc_id long, text string")
    started = time.time()
    row = secret_scan.scan(docs).first()
    assert len(row.hex) == 20_000 and row.hex[-1].start == 33 * 19_999 and len(row.assign) == 1
    text = secret_scan.redact(docs).first().text
    assert text == " ".join([secret_scan.MARK] * 20_001)
    assert time.time() - started < 60


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 200])
def test_running_values(spark, n):
    numbers = [RNG.randint(-5, 9) for _ in range(n)]
    frame = spark.createDataFrame([(numbers,)], "x array<int>")
    sums, highs = frame.select(
        secret_scan._running(F.col("x"), secret_scan._plus, F.lit(0)),
        secret_scan._running(F.col("x"), F.greatest, F.lit(-9)),
    ).first()
    assert sums == [sum(numbers[: i + 1]) for i in range(n)]
    assert highs == [max(numbers[: i + 1]) for i in range(n)]
