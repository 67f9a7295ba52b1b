"""The posting steps on small envelopes, and the sources that read them."""

import json

import pytest
from pyspark.sql import functions as F

from vacatia.operators import quality
from vacatia.plans import steps
from vacatia.sources import envelopes, flatten

JD = "Phát triển hệ thống backend bằng Python và Django cho khách hàng. " * 5


def env(source, job, title, company="Cty A", city="Hà Nội", at="2026-11-01T06:00Z", version=1, jd=JD):
    return {"metadata": {"source": source, "job_id": job, "source_url": f"https://x/{job}", "scraped_at": at, "version": version}, "raw_payload": {"title": title, "company": company, "location": city, "description": jd, "salary": "15 - 20 triệu"}}


CORPUS = [
    ("2026-10-20/1_v1.json", "snapshot", env("src_a", "1", "Backend Developer", at="2026-10-20T06:00Z")),
    ("2026-11-01/1_v2.json", "snapshot", env("src_a", "1", "Senior Backend Developer", version=2)),
    ("2026-11-01/2_v1.json", "snapshot", env("src_a", "2", "Kế toán trưởng")),
    ("2026-11-01/3_v1.json", "snapshot", env("src_a", "3", "Python Dev", jd="Liên hệ để biết thêm")),
    ("2026-11-01/4_v1.json", "snapshot", env("src_a", "4", "Senior Backend Developer", company="CÔNG TY A", at="2026-11-01T05:00Z")),
    ("2026-11-01/job-mot-100_v1.json", "snapshot", env("src_a", "job-mot-100", "Tester")),
    ("2026-10-16/batch.json", "batch", env("src_a", "2", "Kế toán trưởng")),
    ("2026-10-16/batch.json", "batch", env("src_a", "9", "QA Engineer")),
    ("2026-11-01/7_v1.json", "snapshot", env("src_b", "7", "Senior Backend Developer", city="Ha Noi")),
]


def frame(spark, rows):
    return spark.createDataFrame([(f, k, json.dumps(e, ensure_ascii=False)) for f, k, e in rows], "file string, kind string, j string").select("file", "kind", F.parse_json("j").alias("envelope"))


def test_clean_rules(spark):
    kept, dropped = steps.clean(frame(spark, CORPUS))
    assert {r["rule"]: r["count"] for r in dropped.groupBy("rule").count().collect()} == {"C1": 1, "C2": 1, "C3": 1, "C5": 1, "C6": 1, "C7": 1}
    assert sorted(r["source_job_id"] for r in kept.collect()) == ["1", "2", "9"]
    assert kept.filter("source_job_id = '1'").first()["also_on"] == ["src_b:7"]
    assert kept.count() + dropped.count() == len(CORPUS)


def test_policy(spark):
    policy = spark.createDataFrame([("src_a", "non_it")], "source_platform string, it_status string")
    _, dropped = steps.clean(frame(spark, CORPUS), policy)
    assert dropped.filter("rule = 'C4c'").count() == 1


def test_later_steps_keep_rows(spark):
    kept, _ = steps.clean(frame(spark, CORPUS))
    typed = steps.transform(steps.integrate(kept))
    done = steps.normalise(typed)
    assert done.count() == kept.count()
    r = done.filter("source_job_id = '1'").first()
    assert (r["salary_min_vnd"], r["salary_max_vnd"], r["salary_source"], r["seniority"], r["job_family"], r["tinh_chinh"]) == (15e6, 20e6, "header", "Senior", "Backend", "TP. Hà Nội")
    features = steps.encode_features(done)
    hot = [c for c in features.columns if c.startswith("job_family__")]
    assert features.select(sum((F.col(c) for c in hot), F.lit(0)).alias("s")).distinct().collect()[0]["s"] == 1


def test_raw_reader(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "_index").mkdir()
    (tmp_path / "a/1.json").write_text(json.dumps(CORPUS[0][2]))
    (tmp_path / "a/b.json").write_text(json.dumps([CORPUS[1][2], CORPUS[2][2]]))
    (tmp_path / "a/broken.json").write_text('{"hỏng": ')
    (tmp_path / "a/other.json").write_text('{"x": 1}')
    (tmp_path / "_index/skip.json").write_text("{}")
    kinds = {r["kind"]: r["count"] for r in envelopes.read_raw(spark, str(tmp_path)).groupBy("kind").count().collect()}
    assert kinds == {"snapshot": 1, "batch": 2, "broken": 1, "not_envelope": 1}


def test_bad_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n{"hỏng": \n')
    assert [r["broken"] for r in envelopes.read_lines(spark, str(tmp_path / "x.jsonl")).orderBy("line").collect()] == [None, '{"hỏng": ']


def test_sites(spark):
    rows = [
        ("careerviet", {"title": "T", "detail-box": ["Ngày cập nhật 28/10/2026", "Lương Lương: 28 - 70 Triệu VND", "Kinh nghiệm Trên 2 Năm"]}, {"raw_salary_text": "28 - 70 Triệu VND", "raw_experience_text": "Trên 2 Năm", "raw_posted_date": "28/10/2026"}),
        ("itviec", {"sections": {"Mô tả": ["a", "b"]}, "job_posting_jsonld": {"experienceRequirements": {"monthsOfExperience": 30}}}, {"raw_description_text": "a\nb", "raw_experience_text": "2.5 năm (30 tháng)"}),
        ("vietnamworks", {"highestDegreeId": 4, "skills": [{"skillName": "Java"}, "Go"], "salaryMin": 0, "prettySalary": "Thương lượng"}, {"raw_education_text": "Cử nhân / Đại học", "skills_list": ["Java", "Go"], "raw_salary_text": "Thương lượng"}),
        ("topdev", {"company": {"name": "N"}, "content": "<p>a</p>b"}, {"company_name": "N", "raw_description_text": "a\nb"}),
        ("vieclam24h", {"description": ["- a", "b", "- c"]}, {"raw_description_text": "- a b\n- c"}),
        ("glints", {"requirements": "Đại học CNTT\n2 năm kinh nghiệm"}, {"raw_education_text": "Đại học CNTT", "raw_experience_text": "2 năm kinh nghiệm"}),
        ("topcv", {"general_info": {"Cấp bậc": "Nhân viên"}, "overview_tags": {"Chuyên môn": ["Java"]}}, {"raw_seniority_text": "Nhân viên", "skills_list": ["Java"]}),
        ("jobsgo", {"occupations": ["IT", "QA"], "description_bullets": ["x", "y"]}, {"raw_category_text": "IT, QA", "raw_description_text": "x\ny"}),
    ]
    df = frame(spark, [(s, "snapshot", {"metadata": {"source": s, "job_id": "1"}, "raw_payload": p}) for s, p, _ in rows])
    got = {r["source_platform"]: r.asDict() for r in flatten.flatten(df).collect()}
    for s, _, want in rows:
        assert {k: got[s][k] for k in want} == want


def test_conservation(spark):
    r = quality.StepReport("s")
    df = r.count(spark.range(10), "in")
    r.count(df.filter("id > 2"), "out").collect()
    with pytest.raises(quality.NotConserved):
        r.check()


def test_any_layout(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"jobs": [{"id": 1, "t": "x"}, {"jobId": "2"}, {"t": "no id"}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"job_id": "1", "t": "again"}, {"metadata": {"job_id": "3"}, "raw_payload": {"t": "y"}}, {"t": "no id"}]))
    (tmp_path / "manifest.json").write_text("[]")
    got = envelopes.load_any(spark, str(tmp_path))
    assert sorted(str(r["id"]) for r in got.collect()) == ["1", "2", "3", "None", "None"]
    assert got.filter("id = '1'").selectExpr("try_variant_get(payload, '$.t', 'string') as t").first()["t"] == "x"


def test_writers_round_trip(spark, tmp_path):
    from vacatia.sources import sinks

    df = spark.createDataFrame([("a", "1", ["x", 'y "z"'], "2026-11-01"), ("b", "2", [], "2026-11-02")], "source_platform string, id string, tags array<string>, day string")
    sinks.lines(df, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 2
    sinks.csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", "true").option("escape", '"').csv(str(tmp_path / "csv"))
    assert {r["id"]: json.loads(r["tags"]) for r in back.collect()} == {"1": ["x", 'y "z"'], "2": []}
    sinks.by_source(df, str(tmp_path / "parts"))
    assert sorted(p.name for p in (tmp_path / "parts").glob("source_platform=*")) == ["source_platform=a", "source_platform=b"]
    sinks.snapshots(df, str(tmp_path / "snap"))
    sinks.snapshots(df, str(tmp_path / "snap"))
    assert spark.read.json(str(tmp_path / "snap")).count() == 4
    assert not (tmp_path / "dry").exists() and sinks.parquet(df, str(tmp_path / "dry"), ["id"], write=False).columns == ["id"] and not (tmp_path / "dry").exists()
    assert sinks.markdown(df.select("id").orderBy("id")).splitlines() == ["| id |", "|---|", "| 1 |", "| 2 |"]


def test_quantiles_of_many_and_few(spark):
    import numpy as np

    from vacatia.operators import stats

    rng = np.random.default_rng(4)
    for v in ([], [3.0], [1.0, 1.0, 1.0], rng.normal(size=20_000).tolist(), [0.0] * 9000 + [1e9], rng.lognormal(5, 3, 30_000).tolist()):
        df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
        got = stats.exact_quantiles(df, "v", (0.0, 0.01, 0.5, 0.99, 1.0))
        assert got == [None] * 5 if not v else np.allclose(got, np.quantile(v, [0, 0.01, 0.5, 0.99, 1]))


def test_quantiles_with_infinities(spark):
    from vacatia.operators import stats

    inf = float("inf")
    df = spark.createDataFrame([(float(x),) for x in range(6000)] + [(inf,)] * 3 + [(-inf,)], "v double")
    assert stats.exact_quantiles(df, "v", (0.0, 0.5, 0.9999, 1.0)) == [-inf, 3000.5, inf, inf]


def test_rows_without_a_key_share_none(spark):
    from vacatia.operators import dedup

    df = spark.createDataFrame([(i, None if i < 5 else "k", "s" if i % 2 else "t") for i in range(8)], "id int, key string, source string")
    got = {r["id"]: (r["kept"], r["also_on"]) for r in dedup.across_sources(df, "key", "source", "id", [F.asc("id")]).collect()}
    assert got == {**{i: (True, []) for i in range(5)}, 5: (True, ["t:6", "s:7"]), 6: (False, []), 7: (False, [])}
