"""Raw postings of eight sites as one flat row each.

A site is a table of paths: for each column, the places in the payload that may hold it, best first. What paths can't say
(labelled lines, sections, code lists) is an expression over the payload beside them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacatia.functions.arrays import distinct_ci
from vacatia.functions.text import empty_to_null, stitch_bullets, strip_html

# The flat columns, in order.
KEYS = ("job_id_global", "source_platform", "source_job_id", "source_url", "crawled_at")
TEXTS = (
    "job_title", "company_name", "company_address", "company_scale", "raw_category_text", "raw_location_text", "raw_posted_date", "raw_updated_at",
    "raw_deadline", "raw_working_time", "raw_salary_text", "raw_employment_type", "raw_work_mode", "raw_experience_text", "raw_seniority_text",
    "raw_education_text", "raw_headcount", "raw_age_text", "raw_gender_text", "raw_description_text", "raw_requirements_text",
)
LISTS = ("working_locations", "skills_list", "benefits_list")
# The contract after integration.
CLEAN = ("it_rule", "it_rule_level", "it_status", "dedup_key", "also_on")
KEPT = (
    "job_title", "company_name", "company_address", "raw_category_text", "raw_location_text", "working_locations", "raw_posted_date", "raw_deadline",
    "raw_salary_text", "raw_employment_type", "raw_experience_text", "raw_seniority_text", "raw_education_text", "raw_headcount", "skills_list",
    "benefits_list", "raw_description_text", "raw_requirements_text",
)

# Code lists.
DEGREES = {1: "Trung học phổ thông", 2: "Trung cấp", 3: "Cao đẳng", 4: "Cử nhân / Đại học", 5: "Thạc sĩ", 6: "Tiến sĩ", 7: "Khác"}
WORK_TYPES = {1: "Toàn thời gian", 2: "Bán thời gian", 3: "Thực tập", 4: "Khác"}

P = "payload"
_DEGREE_WORDS = r"(?iu)đại học|cao đẳng|cử nhân|thạc sĩ"


def _get(path: str, kind: str, of: str = P) -> Column:
    steps = "".join(f"['{p}']" if not p.startswith("[") else p for p in path.split("/"))
    quoted = steps.replace("'", "\\'")
    return F.expr(f"try_variant_get({of}, '${quoted}', '{kind}')")


def text(*paths: str, of: str = P) -> Column:
    """The first path with a scalar that is not blank."""
    one = lambda p: F.trim(_get(p, "string", of))
    return F.coalesce(*[F.when((one(p) != "") & ~one(p).rlike(r"^[\[{]"), one(p)) for p in paths])


def items(path: str) -> Column:
    """A list's scalars as trimmed texts; empty if there is no list."""
    got = F.filter(F.transform(F.coalesce(_get(path, "array<string>"), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(got, F.array().cast("array<string>"))


def objects(path: str, *names: str) -> Column:
    tries = ", ".join(f"try_variant_get(x, '$.{n}', 'string')" for n in names)
    plain = "case when not startswith(try_variant_get(x, '$', 'string'), '{') then try_variant_get(x, '$', 'string') end"
    steps = "".join(f"[\\'{p}\\']" for p in path.split("/"))
    return F.expr(f"filter(transform(coalesce(try_variant_get({P}, '${steps}', 'array<variant>'), array()), x -> trim(coalesce({tries}, {plain}))), x -> x <> '')")


def lines(path: str) -> Column:
    """A list, or the lines of a text."""
    held = items(path)
    return F.when(F.size(held) > 0, held).otherwise(F.filter(F.transform(F.split(F.coalesce(text(path), F.lit("")), r"\r?\n"), lambda x: F.trim(x)), lambda x: x != ""))


def split(path: str, separators: str = r"[,|;/•]+") -> Column:
    """A list, or the parts of a text."""
    held = items(path)
    return F.when(F.size(held) > 0, held).otherwise(F.filter(F.transform(F.split(F.coalesce(text(path), F.lit("")), separators), lambda x: F.trim(x)), lambda x: x != ""))


def joined(path: str) -> Column:
    return F.coalesce(empty_to_null(F.array_join(items(path), "\n")), text(path))


def stitched(path: str) -> Column:
    held = items(path)
    return F.when(F.size(held) > 0, F.array_join(stitch_bullets(held), "\n")).otherwise(text(path))


def last_line(path: str, *tests: tuple[str, int]) -> Column:
    """The last of a list's lines that has a label among its first characters, without the label."""
    low = lambda x, label, n: F.contains(F.substring(F.lower(x), 1, n), F.lit(label))
    hit = lambda x: reduce(lambda a, b: a | b, [low(x, label, n) for label, n in tests])
    found = F.get(F.reverse(F.filter(items(path), hit)), F.lit(0))
    labels = "|".join(label for label, _ in tests)
    return F.trim(F.regexp_replace(found, rf"(?iu)^(?:(?:{labels})(?: nộp| tuyển)?\s*)+:?", ""))


def _ld(path: str, what: str) -> Column:
    """what: locality, street or place of the JSON-LD locations."""
    steps = "".join(f"[\\'{p}\\']" for p in path.split("/"))
    listed = f"coalesce(try_variant_get({P}, '${steps}', 'array<variant>'), array(try_variant_get({P}, '${steps}', 'variant')))"
    locality = "coalesce(try_variant_get(x, '$.address.addressLocality', 'string'), try_variant_get(x, '$.address.addressRegion', 'string'), try_variant_get(x, '$.addressLocality', 'string'), case when not startswith(try_variant_get(x, '$', 'string'), '{') then try_variant_get(x, '$', 'string') end)"
    street = "coalesce(try_variant_get(x, '$.address.streetAddress', 'string'), case when not startswith(try_variant_get(x, '$.address', 'string'), '{') then try_variant_get(x, '$.address', 'string') end)"
    body = {"locality": locality, "street": street, "place": f"coalesce({street}, {locality})"}[what]
    return F.expr(f"filter(transform({listed}, x -> trim({body})), x -> x <> '')")


def first(c: Column) -> Column:
    return F.get(c, F.lit(0))


def coded(path: str, names: dict[int, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, _get(path, "int")), text(path))


def amount(low: str, high: str, currency: str, default: str) -> Column:
    a, b = _get(low, "double"), _get(high, "double")
    shown = lambda p: F.coalesce(_get(p, "string"), F.lit("0"))
    return F.when((F.coalesce(a, F.lit(0.0)) > 0) | (F.coalesce(b, F.lit(0.0)) > 0), F.concat(shown(low), F.lit(" - "), shown(high), F.lit(" "), F.coalesce(text(currency), F.lit(default))))


LD = "job_posting_jsonld"
_req = lambda test: first(F.filter(lines("requirements"), lambda x: x.rlike(test)))


def _section_lines(*words: str) -> Column:
    tests = " or ".join(f"contains(lower(k), '{w}')" for w in words)
    held = f"map_filter(coalesce(try_variant_get({P}, '$.sections', 'map<string,variant>'), map()), (k, v) -> {tests})"
    return F.expr(f"flatten(transform(map_values({held}), v -> coalesce(try_variant_get(v, '$', 'array<string>'), array(try_variant_get(v, '$', 'string')))))")


def _careerviet() -> dict[str, Column]:
    box = "detail-box"
    return {
        "job_title": text("title"), "company_name": text("job-company-name"), "raw_location_text": text("map"), "company_address": text("detail-row/Địa điểm làm việc"),
        "raw_salary_text": last_line(box, ("lương", 10)), "raw_experience_text": last_line(box, ("kinh nghiệm", 15)), "raw_seniority_text": last_line(box, ("cấp bậc", 12)),
        "raw_deadline": last_line(box, ("hết hạn", 15)), "raw_updated_at": last_line(box, ("ngày cập nhật", 15)), "raw_posted_date": last_line(box, ("ngày cập nhật", 15)),
        "raw_employment_type": last_line(box, ("hình thức", 15)), "raw_category_text": F.coalesce(last_line(box, ("ngành nghề", 15)), empty_to_null(F.array_join(items("Ngành nghề"), ", ")), text("Ngành nghề")),
        "raw_education_text": last_line(box, ("bằng cấp", 200), ("trình độ", 200)), "raw_headcount": last_line(box, ("số lượng", 200), ("chỉ tiêu", 200)),
        "raw_age_text": last_line(box, ("độ tuổi", 200)), "raw_gender_text": last_line(box, ("giới tính", 200)),
        "raw_description_text": text("detail-row/Mô tả Công việc"), "raw_requirements_text": text("detail-row/Yêu Cầu Công Việc"),
        "working_locations": F.array_compact(F.array(text("map"), text("detail-row/Địa điểm làm việc"))), "benefits_list": split("detail-row/Phúc lợi", r"[\n\r;•*-]+"),
        "skills_list": F.concat(split("skills"), split("skills_list")),
    }


def _glints() -> dict[str, Column]:
    onsite = F.filter(F.transform(lines("requirements"), lambda x: F.when(x.rlike("(?iu)làm tại công ty"), "Làm tại công ty / Onsite").when(x.rlike("(?iu)từ xa|remote"), "Làm việc từ xa / Remote").when(x.rlike("(?iu)hybrid|kết hợp"), "Hybrid")), lambda x: x.isNotNull())
    return {
        "job_title": text("job-title", "title", f"{LD}/title"), "company_name": text("company-name", "company"), "raw_salary_text": text("salary"), "raw_description_text": text("description"),
        "raw_requirements_text": text("requirements"), "raw_work_mode": first(F.reverse(onsite)), "raw_experience_text": _req("(?iu)năm kinh nghiệm"),
        "raw_education_text": F.coalesce(text(f"{LD}/educationRequirements/credentialCategory", f"{LD}/educationRequirements"), _req(_DEGREE_WORDS)),
        "raw_posted_date": text(f"{LD}/datePosted"), "raw_deadline": text(f"{LD}/validThrough"), "raw_employment_type": text(f"{LD}/employmentType"), "raw_category_text": text(f"{LD}/occupationalCategory", f"{LD}/industry"),
        "raw_location_text": first(_ld(f"{LD}/jobLocation", "locality")), "company_address": first(_ld(f"{LD}/jobLocation", "street")), "working_locations": _ld(f"{LD}/jobLocation", "place"),
        "skills_list": F.filter(split("skills"), lambda x: F.lower(x) != "kỹ năng"), "benefits_list": F.filter(lines("benefits"), lambda x: ~F.contains(F.lower(x), F.lit("job benefits"))),
    }


def _itviec() -> dict[str, Column]:
    pay = f"{LD}/baseSalary"
    months = _get(f"{LD}/experienceRequirements/monthsOfExperience", "int")
    own = _section_lines("tại sao", "phúc lợi", "lý do")
    return {
        "job_title": text("title"), "company_name": text("company_name", "company"), "raw_location_text": F.coalesce(text("work_location"), first(_ld(f"{LD}/jobLocation", "locality"))),
        "raw_posted_date": text(f"{LD}/datePosted", "posted_at_raw"), "raw_deadline": text(f"{LD}/validThrough"), "raw_employment_type": text(f"{LD}/employmentType"), "raw_category_text": text(f"{LD}/industry"),
        "raw_salary_text": F.coalesce(amount(f"{pay}/value/minValue", f"{pay}/value/maxValue", f"{pay}/currency", "USD"), F.concat(text(f"{pay}/value"), F.lit(" "), F.coalesce(text(f"{pay}/currency"), F.lit("USD"))), text("salary_display_text")),
        "raw_experience_text": F.when(months > 0, F.concat(F.format_string("%.1f", F.bround(months / 12, 1)), F.lit(" năm ("), months.cast("string"), F.lit(" tháng)"))),
        "raw_description_text": empty_to_null(F.array_join(_section_lines("mô tả"), "\n")), "raw_requirements_text": empty_to_null(F.array_join(_section_lines("yêu cầu"), "\n")),
        "company_address": first(_ld(f"{LD}/jobLocation", "street")), "working_locations": _ld(f"{LD}/jobLocation", "place"),
        "skills_list": F.concat(split(f"{LD}/skills", ","), items("skill_tags"), items("skills")),
        "benefits_list": F.when(F.size(own) > 0, own).otherwise(F.split(F.coalesce(strip_html(text(f"{LD}/jobBenefits")), F.lit("")), "\n")),
    }


def _jobsgo() -> dict[str, Column]:
    return {
        "job_title": text("title"), "company_name": text("company"), "company_address": text("company_address"), "raw_salary_text": text("salary_raw"), "raw_experience_text": text("experience"),
        "raw_location_text": text("location"), "raw_deadline": text("deadline_raw"), "raw_education_text": text("education"), "raw_working_time": text("working_time"),
        "raw_category_text": empty_to_null(F.array_join(items("occupations"), ", ")), "raw_seniority_text": text("general_info/job_level"), "raw_posted_date": text("general_info/posted_date"),
        "raw_employment_type": text("general_info/employment_type"), "raw_headcount": text("general_info/hiring_quantity"), "raw_gender_text": text("general_info/gender"), "raw_age_text": text("general_info/age"),
        "raw_description_text": joined("description_bullets"), "raw_requirements_text": joined("requirements_bullets"), "working_locations": items("working_places"),
        "skills_list": F.concat(split("skills"), split("skills_list")), "benefits_list": items("benefits_bullets"),
    }


def _topcv() -> dict[str, Column]:
    info, tags = "general_info", "overview_tags"
    asked = lambda test: first(F.filter(items(f"{tags}/Yêu cầu"), lambda x: x.rlike(test)))
    return {
        "job_title": text("title"), "company_name": text("company"), "company_address": text("company_address"), "company_scale": text("company_scale"), "raw_salary_text": text("salary_raw"),
        "raw_experience_text": text("experience"), "raw_location_text": text("location"), "raw_deadline": text("deadline_raw"), "raw_working_time": text("working_time"), "raw_category_text": text("company_industry"),
        "raw_seniority_text": text(f"{info}/Cấp bậc"), "raw_education_text": F.coalesce(text(f"{info}/Học vấn", f"{info}/Bằng cấp"), asked(_DEGREE_WORDS)), "raw_headcount": text(f"{info}/Số lượng tuyển"),
        "raw_employment_type": text(f"{info}/Loại hình làm việc", f"{info}/Hình thức làm việc"), "raw_gender_text": text(f"{info}/Giới tính"), "raw_age_text": F.coalesce(text(f"{info}/Độ tuổi"), asked("(?iu)tuổi")),
        "raw_work_mode": text(f"{info}/Hình thức làm việc"), "raw_description_text": joined("description_bullets"), "raw_requirements_text": joined("requirements_bullets"), "working_locations": lines("working_places"),
        "skills_list": F.concat(items(f"{tags}/Chuyên môn"), items("required_skills"), items("industry_knowledge")),
        "benefits_list": F.concat(items(f"{tags}/Quyền lợi"), items("welfare_tags"), items("allowance_tags"), items("benefits_bullets")),
    }


def _topdev() -> dict[str, Column]:
    months = text(f"{LD}/experienceRequirements/monthsOfExperience")
    return {
        "job_title": text("title", "job-title"), "raw_salary_text": text("salary_raw", "salary"), "raw_posted_date": text("published/date", "published", "date_posted", f"{LD}/datePosted", "recalled_at", "created_at"),
        "raw_experience_text": F.coalesce(F.concat(months, F.lit(" months")), text(f"{LD}/experienceRequirements", "experience", "extra/experience", "experiences_str")),
        "raw_seniority_text": text("seniority_text", "job_level", "job_levels_str"), "company_name": text("company/company_name", "company/name", "company", "company-name"), "company_scale": text("company/company_size", "company/scale"),
        "raw_location_text": F.coalesce(empty_to_null(F.array_join(items("addresses/address_region_list"), ", ")), text("addresses/address_region_list")), "company_address": text("addresses/full_address"),
        "working_locations": F.concat(items("addresses/full_addresses"), objects("addresses/collection_addresses", "full_address")), "raw_description_text": strip_html(text("responsibilities_original", "content")),
        "raw_requirements_text": strip_html(text("requirements_original")), "skills_list": F.when(F.size(items("skills_arr")) > 0, items("skills_arr")).otherwise(split("skills_str", ",")),
        "benefits_list": F.array_compact(F.transform(F.when(F.size(objects("benefits_original", "value")) > 0, objects("benefits_original", "value")).otherwise(objects("benefits_v2", "value")), strip_html)),
    }


def _vieclam24h() -> dict[str, Column]:
    info = "general_info"
    return {
        "job_title": text("title"), "raw_salary_text": text("salary"), "raw_experience_text": text("experience_summary"), "raw_location_text": text("location_summary"), "raw_deadline": text("deadline"),
        "raw_working_time": text("working_time"), "company_address": text("working_address", "company/address"), "company_name": text("company/name", "company"), "company_scale": text("company/scale"),
        "raw_seniority_text": text(f"{info}/level"), "raw_posted_date": text(f"{info}/posted_date"), "raw_headcount": text(f"{info}/hiring_quantity"), "raw_employment_type": text(f"{info}/working_type"),
        "raw_category_text": text(f"{info}/industries"), "raw_education_text": text(f"{info}/education", f"{info}/degree"), "raw_gender_text": text(f"{info}/gender"), "raw_age_text": text(f"{info}/age"),
        "working_locations": F.concat(F.array_compact(F.array(text("working_address"))), items(f"{info}/workplaces")), "raw_description_text": stitched("description"), "raw_requirements_text": stitched("requirements"),
        "benefits_list": F.when(F.size(items("benefits")) > 0, stitch_bullets(items("benefits"))).otherwise(F.array_compact(F.array(text("benefits")))), "skills_list": items("keywords"),
    }


def _vietnamworks() -> dict[str, Column]:
    years = _get("yearsOfExperience", "int")
    industries = lambda p: empty_to_null(F.array_join(objects(p, "industryV3NameVI", "industryV3Name", "industryNameVI", "industryName"), ", "))
    return {
        "job_title": text("jobTitle", "title"), "company_name": text("companyName", "company/name"), "raw_posted_date": text("createdOn", "approvedOn", "onlineOn"), "raw_updated_at": text("lastUpdatedOn"),
        "raw_deadline": text("expiredOn"), "raw_seniority_text": text("jobLevelVI", "jobLevel"), "raw_location_text": text("location"), "company_address": text("address"), "company_scale": text("companySizeVI", "companySize"),
        "raw_headcount": text("numberOfRecruits"), "raw_age_text": text("rangeAge"), "raw_gender_text": F.when(text("isShowGender").isNotNull(), F.coalesce(text("gender"), F.lit("Không hiển thị"))),
        "raw_education_text": coded("highestDegreeId", DEGREES), "raw_employment_type": coded("typeWorkingId", WORK_TYPES), "raw_category_text": F.coalesce(industries("industriesV3"), industries("industries")),
        "raw_experience_text": F.when(years > 0, F.concat(years.cast("string"), F.lit(" năm"))), "raw_salary_text": F.coalesce(amount("salaryMin", "salaryMax", "salaryCurrency", "VND"), text("prettySalary", "salary_raw")),
        "working_locations": F.concat(objects("workingLocations", "address", "streetName"), F.array_compact(F.array(text("address")))), "skills_list": objects("skills", "skillName"), "benefits_list": objects("benefits", "benefitValue"),
        "raw_description_text": F.coalesce(joined("description_list"), text("jobDescription")), "raw_requirements_text": F.coalesce(joined("requirements_list"), text("jobRequirement")),
    }


def _other() -> dict[str, Column]:
    return {"job_title": text("title"), "company_name": text("company"), "raw_salary_text": text("salary", "salary_raw"), "raw_experience_text": text("experience"), "raw_location_text": text("location"), "raw_description_text": text("description")}


SITES: dict[str, Callable[[], dict[str, Column]]] = {
    "careerviet": _careerviet, "glints": _glints, "itviec": _itviec, "jobsgo": _jobsgo, "topcv": _topcv, "topdev": _topdev, "vieclam24h": _vieclam24h, "vietnamworks": _vietnamworks,
}


def flatten(envelopes: DataFrame, envelope: str = "envelope") -> DataFrame:
    """The flat columns of each envelope (variant), other columns kept. One branch a site, each over its own rows."""
    meta = lambda *names: F.coalesce(*[text(f"{m}/{n}", of=envelope) for n in names for m in ("metadata", "_meta")])
    base = envelopes.withColumn("source_platform", F.lower(F.coalesce(meta("source", "source_platform"), F.lit("unknown"))))
    base = base.withColumn("source_job_id", F.coalesce(meta("job_id", "source_job_id"), F.lit(""))).withColumn("job_id_global", F.concat_ws("_", "source_platform", "source_job_id"))
    base = base.withColumn("source_url", F.coalesce(meta("source_url", "url"), F.lit(""))).withColumn("crawled_at", F.coalesce(meta("scraped_at", "crawled_at"), F.lit("")))
    base = base.withColumn("version", F.coalesce(meta("version").try_cast("int"), F.lit(1))).withColumn(P, F.coalesce(_get("raw_payload", "variant", envelope), _get("raw", "variant", envelope)))
    others = [c for c in base.columns if c not in (P, envelope, *KEYS)]

    def site(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
        texts = [columns.get(c, F.lit(None)).cast("string").alias(c) for c in TEXTS]
        lists = [distinct_ci(F.filter(F.transform(columns.get(c, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")).alias(c) for c in LISTS]
        return rows.select(*KEYS, *others, *texts, *lists)

    parts = [site(base.filter(F.col("source_platform") == name), columns()) for name, columns in SITES.items()]
    return reduce(DataFrame.union, parts, site(base.filter(~F.col("source_platform").isin(*SITES)), _other()))
