"""Literal cases of the functions."""

import json

import pytest
from pyspark.sql import functions as F

from vacatia.functions import arrays, classify, dates, money, places, text, urls


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def many(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


SALARIES = {
    "Up to 2,000 USD": (None, 50.8e6), "Từ 15 triệu": (15e6, None), "8.5 - 12 triệu": (8.5e6, 12e6), "15 - 25 triệu": (15e6, 25e6), "1,000 - 2,000 USD": (25.4e6, 50.8e6),
    "360 triệu / năm": (30e6, 30e6), "Thỏa thuận": (None, None), "Up to 40.000.000 VND": (None, 40e6), "From 9.000.000 VND": (9e6, None), "Trưởng nhóm 20 - 30": (20e6, 30e6),
    "10.000.000 - 30.000.000": (10e6, 30e6), "": (None, None), None: (None, None),
}


def test_salary(spark):
    got = many(spark, list(SALARIES), money.salary)
    assert [(r["low"], r["high"]) for r in got] == list(SALARIES.values())
    flags = dict(zip(SALARIES, got, strict=True))
    assert flags["Thỏa thuận"]["negotiable"] and flags[""]["negotiable"] and not flags["Từ 15 triệu"]["negotiable"]
    assert one(spark, "0.5 - 1 triệu", money.salary)["under_1m"]


CASCADES = [
    (("Thỏa thuận", "Senior Java Dev (15-20tr)", None), ("title", 15e6, 20e6, False)),
    ((None, "Business Analyst (2+ Năm Kinh Nghiệm) - Upto 35 Triệu", None), ("title", None, 35e6, False)),
    (("300 - 900 triệu", "", None), ("header", None, None, True)),
    (("0 - 30000000 VND", None, None), ("header", None, 30e6, False)),
    ((None, "Dev 2026TD450981 Microsoft 365", "Mô tả.\nThu nhập: 20-30 triệu; ok"), ("jd", 20e6, 30e6, False)),
    ((None, "Kỹ sư Bậc 1", "Liên hệ 0123"), ("none", None, None, False)),
]


def test_salary_cascade(spark):
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(CASCADES)], "i int, h string, t string, d string")
    got = df.select("i", money.salary_cascade(F.col("h"), F.col("t"), F.col("d")).alias("s")).orderBy("i").select("s.*").collect()
    assert [(r["source"], r["low"], r["high"], r["suspect"]) for r in got] == [w for _, w in CASCADES]


def test_experience(spark):
    cases = {"Không yêu cầu": (0, 0), "1 - 2 năm": (1, 2), "1 to 2 years": (1, 2), "Trên 3 năm": (3, None), "3+ years": (3, None), "Dưới 1 năm": (0, 1), "24 months": (2, 2), "6 tháng": (0.5, 0.5), "2": (2, 2), "": (None, None)}
    assert [(r["low"], r["high"]) for r in many(spark, list(cases), money.experience)] == list(cases.values())


def test_dates(spark):
    assert [str(d) for d in many(spark, ["2026-10-14T04:20:13.27873Z", "15/10/2026", "2026-11-01", "31/02/2026", "x", None], dates.parse_date)] == ["2026-10-14", "2026-10-15", "2026-11-01", "None", "None", "None"]
    assert one(spark, "2027-01-01", lambda c: dates.iso_week(F.to_date(c))) == "2026-W53"


def test_places(spark):
    cases = {"1 Nguyễn Huệ, Quận 1": None, "Số 5 Điện Biên Phủ, TP. Hồ Chí Minh": "ho_chi_minh", "Bà Rịa - Vũng Tàu": "ho_chi_minh", "Hà Nội; Huế": "hue", "Hà Nội": "ha_noi", "": None}
    assert many(spark, list(cases), places.province) == list(cases.values())
    a = one(spark, "Hà Nội : Số 181 Trần Duy Hưng, Quận Cầu Giấy, Hà Nội, Việt Nam", places.address)
    assert (a["street"], a["province"], a["ward"]) == ("Số 181 Trần Duy Hưng", "TP. Hà Nội", None)
    assert many(spark, ["Remote", "Singapore"], places.is_remote) == [True, False]


def test_classification(spark):
    titles = ["Backend Developer", "International Sales", "Kế toán trưởng", "IT Recruiter", "Business Analyst", None]
    none = F.array().cast("array<string>")
    assert many(spark, titles, lambda t: classify.relevance(t, none)) == ["it", "non_it", "non_it", "unknown", "it", "unknown"]
    assert many(spark, ["Intern QA", "International Sales", "Backend Developer"], lambda t: classify.level(F.lit(None).cast("string"), t, F.lit(None).cast("double"))["level"]) == ["Thực tập", "Chưa rõ", "Chưa rõ"]
    assert many(spark, [0.0, 0.5, 1.5, 2.5, 4.0, 6.0], lambda y: classify.level(F.lit(None).cast("string"), F.lit(""), y)["level"], "double") == ["Mới tốt nghiệp", "Chưa rõ", "Junior", "Chưa rõ", "Middle", "Senior"]
    assert many(spark, ["Backend Developer", "BA", "Kế toán"], lambda t: classify.family(t, none)["family"]) == ["Backend", "Phân tích nghiệp vụ (BA)", "Khác"]


def test_skills(spark):
    assert one(spark, ["ReactJS", "React.js", "Java", "Docker", "react"], classify.canonical, "array<string>") == ["React", "Java", "Docker"]
    assert one(spark, "Python, C# and NodeJS; go", classify.skills_in_text) == ["C#", "Node.js", "Python"]


def test_text(spark):
    assert one(spark, "<p>A&amp;B<br>x</p><ul><li>- one</li></ul>", text.strip_html) == "A&B\nx\n- one"
    assert one(spark, ["- a b", "c d.", "• e", "f"], text.stitch_bullets, "array<string>") == ["- a b c d.", "• e f"]
    assert one(spark, "Công ty TNHH ABC Việt Nam", text.company_block) == "abc"
    assert one(spark, "TP. Hồ Chí Minh, Đà Nẵng", text.fold) == "tp ho chi minh da nang"
    assert many(spark, ["[HN/HCM] Senior Java Developer", "Python Developer - Lương 20-25M"], text.clean_title) == ["Senior Java Developer", "Python Developer"]
    assert one(spark, ["Java", "java", " Go "], arrays.distinct_ci, "array<string>") == ["Java", " Go "]


@pytest.mark.parametrize("url", ["HTTPS://A.com/x/?utm_source=1&b=2#f", "http://a.com", "https://a.com/p?ref=q&z=1&a=2"])
def test_canonical_url_is_stable(spark, url):
    once = one(spark, url, urls.canonical)
    assert one(spark, once, urls.canonical) == once


def test_null_kinds(spark):
    values = [None, "nan", "[]", "0", " ", "Thỏa thuận", "N/A", "Java"]
    assert many(spark, values, classify.null_kind) == ["EXPLICIT_NONE", "EXPLICIT_NAN", "EMPTY_CONTAINER", "NUMERIC_ZERO", "WHITESPACE_ONLY", "NEGOTIABLE_MARKER", "TEXT_PLACEHOLDER", "VALID"]


def test_json_hash_ignores_order(spark):
    a, b = ({"x": "1", "y": "2"}, {"y": "2", "x": "1", "t": "now"})
    h = lambda m: one(spark, json.dumps(m), lambda c: urls.canonical_json_hash(F.from_json(c, "map<string,string>"), ("t",)))
    assert h(a) == h(b)
