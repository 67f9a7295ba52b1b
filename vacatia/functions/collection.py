"""Rules of the collection side: they differ from the pipeline's own on purpose, so they have names of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacatia.functions import terms as T
from vacatia.functions.core import let, record
from vacatia.functions.dates import parse_date
from vacatia.functions.text import contains_any, empty_to_null

# Texts without a salary, telling words of tags, closed postings, languages.
NO_SALARY = (
    "thỏa thuận", "thương lượng", "thoả thuận", "negotiable", "competitive", "cạnh tranh", "đăng nhập", "sign in", "xem mức lương", "liên hệ",
    "trao đổi khi phỏng vấn", "trao đổi trực tiếp", "thương lượng sau", "tùy năng lực", "xứng đáng theo năng lực",
)
TAG_KINDS = (
    ("experience", ("kinh nghiệm", "experience", "năm kn")),
    ("education", ("đại học", "cao đẳng", "thạc sĩ", "tiến sĩ", "degree", "university", "college")),
    ("age", ("tuổi", "age")),
    ("benefit", ("bảo hiểm", "insurance", "du lịch", "travel", "team building", "thưởng", "bonus", "phụ cấp", "allowance", "đào tạo", "training", "xe đưa đón", "cơm trưa", "chăm sóc sức khỏe")),
    ("role", ("developer", "engineer", "lập trình viên", "kỹ sư", "manager", "leader", "trưởng nhóm", "quản lý", "consultant", "analyst", "chuyên viên", "product owner", "scrum master", "tester", "qa", "qc", "devops", "sysadmin", "architect")),
)
CLOSED_WORDS = (
    "tin tuyển dụng đã hết hạn", "tin đã hết hạn", "việc làm đã hết hạn", "việc làm này không còn tồn tại", "hết hạn nộp hồ sơ", "đã dừng nhận hồ sơ",
    "ngừng nhận hồ sơ", "vị trí này đã đóng", "công việc này đã đóng", "this job is no longer available", "job has expired", "this job opening is closed",
    "the position has been filled", "job post is expired",
)
CLOSED_STATES = ("closed", "expired", "inactive", "hidden", "disabled")
VI_WORDS = ("và", "của", "các", "cho", "được", "trong", "có", "với", "tuyển", "dụng", "công", "việc", "kinh", "nghiệm", "mức", "lương", "yêu", "cầu", "quyền", "lợi")
VI_PHRASES = (
    "nhân viên", "tuyển dụng", "kinh doanh", "kế toán", "lập trình", "chuyên viên", "thực tập sinh", "tư vấn", "việc làm", "hành chính", "nhân sự",
    "bán hàng", "kỹ thuật", "trách nhiệm", "yêu cầu ứng viên", "phúc lợi", "mô tả công việc", "chế độ", "lương thưởng",
)
EN_PHRASES = (
    "responsibilities", "requirements", "qualifications", "benefits", "we are looking", "what you will do", "about the role", "experience", "skills",
    "job description", "work with", "you will be responsible",
)
IMPUTED_SKILLS = (
    "python", "java", "golang", "c++", "c#", "php", "javascript", "typescript", "react", "vue", "angular", "node.js", "docker", "kubernetes", "aws", "sql",
    "postgresql", "mysql", "mongodb", "redis", "fastapi", "django", "spring", "flutter", "react native", "devops", "ci/cd", "git",
)
IMPUTED_CITIES = (("Hồ Chí Minh", ("hồ chí minh", "hcm", "tp.hcm", "sài gòn")), ("Hà Nội", ("hà nội", "hn", "cầu giấy")), ("Đà Nẵng", ("đà nẵng", "dn")), ("Remote", ("remote", "làm việc từ xa")))
# When crawling may run.
MOST_A_BATCH, EVENING_HOUR, COOLDOWN_MINUTES, RECHECK_DAYS = 30, 20, 55, 21
BLOCK_WORDS = r"(?iu)captcha|cloudflare|access denied|verify you are human|attention required"


def salary_in_source_units(text: Column) -> Column:
    """struct(low, high, currency): numbers as written, so 15 is 15 million; NULL for negotiable texts."""
    none = F.lit(None).cast("double")

    def read(s: Column) -> Column:
        n = F.transform(F.regexp_extract_all(F.regexp_replace(s, r"(\d),(\d{3})", "$1$2"), F.lit(r"\d+(?:\.\d+)?"), F.lit(0)), lambda x: x.cast("double"))
        low = F.lower(s)
        return record(
            a=F.get(n, F.lit(0)), b=F.get(n, F.lit(1)), silent=contains_any(low, NO_SALARY) | (s == ""), usd=contains_any(low, ("usd", "$")),
            ranged=contains_any(s, ("-", "–", "đến", "tới", "to")) & (F.size(n) >= 2), up=contains_any(low, ("lên đến", "tới", "up to", "dưới", "<=")), from_=contains_any(low, ("từ", "trên", "from", ">=")),
        )

    def pick(v: Column) -> Column:
        low = F.when(v["silent"], none).when(v["ranged"], v["a"]).when(v["up"], none).otherwise(v["a"])
        high = F.when(v["silent"], none).when(v["ranged"], v["b"]).when(v["up"], v["a"]).when(v["from_"], none).otherwise(F.coalesce(v["b"], v["a"]))
        return record(low=low, high=high, currency=F.when(v["silent"] | v["a"].isNull(), F.lit(None)).when(v["usd"], "USD").otherwise("VND"))

    return let(F.trim(F.coalesce(text, F.lit(""))), lambda s: let(read(s), pick))


def tag_kinds(tags: Column) -> Column:
    """array<struct(kind, tag)>: the first kind whose words a tag has, else skill."""
    kind = lambda t: reduce(lambda acc, r: acc.when(contains_any(t, r[1]), r[0]), TAG_KINDS[1:], F.when(contains_any(t, TAG_KINDS[0][1]), TAG_KINDS[0][0])).otherwise("skill")
    clean = F.filter(F.transform(tags, lambda t: F.trim(F.regexp_replace(t, r"(?U)\s+", " "))), lambda t: t != "")
    return F.transform(clean, lambda t: record(kind=kind(F.lower(t)), tag=t))


def closed(code: Column, deadline: Column, payload: Column, page: Column, today: Column) -> Column:
    """Whether a posting is over: by HTTP status, deadline, the payload (variant) or the page's words."""
    get = lambda p, kind: F.try_variant_get(payload, f"$.{p}", kind)
    flags = F.coalesce(get("is_closed", "boolean"), F.lit(False)) | ~F.coalesce(get("is_active", "boolean"), F.lit(True)) | F.coalesce(F.lower(get("status", "string")).isin(*CLOSED_STATES), F.lit(False))
    past = lambda c: F.coalesce(parse_date(c) < today, F.lit(False))
    ended = reduce(lambda a, b: a | b, [past(get(k, "string")) for k in ("valid_through", "expired_at", "expiredOn", "deadline", "end_date", "expire_date")])
    return F.coalesce(code.isin(404, 410), F.lit(False)) | past(deadline) | flags | ended | F.coalesce(contains_any(F.lower(page), CLOSED_WORDS), F.lit(False))


def language_by_stopwords(text: Column, brief: bool = True) -> Column:
    """vi or en: marked letters first, then Vietnamese stopwords.

    brief: also the original's rules for little text (vi for null, for no word of letters only, for one stopword in five words);
    without them null is en, and only a text without any letter is vi."""
    s = F.lower(F.translate(F.coalesce(text, F.lit("")) if brief else text, "İ", "i"))  # the only letter that lower() makes two of
    marked = F.regexp_count(s, F.lit(f"[{T.VI_LETTERS}]"))
    words = F.regexp_extract_all(s, F.lit(r"(?U)\b[a-zà-ỹđ]+\b" if brief else r"[\p{L}\p{N}_]+"), F.lit(0))
    hits = F.size(F.filter(words, lambda w: w.isin(*VI_WORDS)))
    bare = (F.size(words) == 0) | ((hits >= 1) & (F.size(words) <= 5)) if brief else ~s.rlike("[a-zà-ỹđ]")
    return F.when((marked >= 1) | bare | (hits >= 2), "vi").otherwise("en")


def language_of_posting(title: Column, company: Column, description: Column) -> Column:
    """vi or en: counts of phrases in a description of 80 characters or more, else any mark in title and company."""
    body, head = F.lower(F.coalesce(description, F.lit(""))), F.lower(F.concat_ws(" ", title, company))
    count = lambda words: F.regexp_count(body, F.lit("|".join(words)))
    marked = F.regexp_count(body, F.lit(f"[{T.VI_LETTERS}]"))
    long = F.when((marked >= 5) | (count(VI_PHRASES) > count(EN_PHRASES)), "vi").otherwise("en")
    return F.when(F.length(F.trim(body)) >= 80, long).when(contains_any(head, VI_PHRASES) | head.rlike(f"[{T.VI_LETTERS}]"), "vi").otherwise("en")


def days_left(payload: Column) -> Column:
    """N of the first "N days left" anywhere in a payload (as JSON text)."""
    found = F.regexp_extract(payload, r"(?iu)\b(\d+)\s+days?\s+left\b|\bcòn\s+(\d+)\s+ngày\b", 0)
    return F.regexp_extract(found, r"(\d+)", 1).try_cast("int")


def blocked(title: Column, html: Column, text: Column) -> Column:
    """A block page: its title says so, or its start does and there is little text."""
    return F.coalesce(title.rlike(BLOCK_WORDS), F.lit(False)) | (F.coalesce(F.substring(html, 1, 20_000).rlike(BLOCK_WORDS), F.lit(False)) & (F.length(F.coalesce(text, F.lit(""))) < 1000))


def impute(title: Column, text: Column) -> Column:
    """struct(years, level, city, skills) guessed from a posting's words."""
    s = F.lower(F.concat_ws("\n", title, text))
    has = lambda *w: contains_any(s, w)
    told = empty_to_null(F.regexp_extract(s, r"(\d+)\s*(?:[-–tođến]+\s*\d+)?\s*năm\s*kinh\s*nghiệm", 1)).try_cast("double")
    years = F.coalesce(told, F.when(has("không yêu cầu kinh nghiệm", "fresher", "thực tập"), 0.0))
    band = F.when(years >= 4, "Senior").when(years >= 2, "Middle").when(years.isNotNull(), "Junior")
    level = F.when(has("intern", "thực tập"), "Intern").when(has("fresher"), "Fresher").when(has("junior"), "Junior").when(has("senior"), "Senior").when(has("lead", "quản lý", "manager"), "Lead").otherwise(band)
    city = reduce(lambda acc, c: acc.when(has(*c[1]), c[0]), IMPUTED_CITIES[1:], F.when(has(*IMPUTED_CITIES[0][1]), IMPUTED_CITIES[0][0]))
    quote = lambda w: "\\Q" + w + "\\E"
    skills = F.slice(F.array_compact(F.array(*[F.when(s.rlike(rf"(?U)\b{quote(w)}\b"), F.lit(w.title())) for w in IMPUTED_SKILLS])), 1, 8)
    return record(years=years, level=level, city=city, skills=skills)


def route(now: Column, backlog: Column, last_end: Column) -> Column:
    """struct(should_run, tier, quota) of a crawl slot; now and last_end are UTC timestamps."""
    at, before = F.from_utc_timestamp(now, "Asia/Ho_Chi_Minh"), F.from_utc_timestamp(last_end, "Asia/Ho_Chi_Minh")
    minutes = (F.unix_seconds(now) - F.unix_seconds(last_end)) / 60
    weekend = F.dayofweek(at).isin(1, 7)
    ran = F.coalesce(((F.to_date(before) == F.to_date(at)) & (F.hour(before) >= EVENING_HOUR)) | (minutes < 180), F.lit(False))
    out = lambda run, tier: record(should_run=F.lit(run), tier=F.lit(tier), quota=F.least(backlog, F.lit(MOST_A_BATCH)) if run else F.lit(0).cast("bigint"))
    return (
        F.when(backlog == 0, out(False, "IDLE"))
        .when(~weekend & (F.hour(at) < EVENING_HOUR), out(False, "WEEKDAY_PAUSE"))
        .when(~weekend & ran, out(False, "WEEKDAY_MAINTENANCE"))
        .when(~weekend, out(True, "WEEKDAY_MAINTENANCE"))
        .when(minutes < COOLDOWN_MINUTES, out(False, "WEEKEND_COOLDOWN"))
        .when(backlog >= 300, out(True, "WEEKEND_SURGE"))
        .when(backlog > 30, out(True, "WEEKEND_MODERATE"))
        .otherwise(out(True, "WEEKEND_NORMAL"))
    )


def page_count(last_page: Column, total: Column, size: Column) -> Column:
    return F.greatest(F.coalesce(last_page, F.lit(0)), F.ceil(total / size).cast("bigint"))


def next_slot(local: Column, weekday: tuple[int, ...], weekend: tuple[int, ...]) -> Column:
    """The first slot hour after a local time, over the next eight days."""
    days = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda n: F.date_add(F.to_date(local), n))
    hours = lambda d: F.when(F.dayofweek(d).isin(1, 7), F.array(*map(F.lit, weekend))).otherwise(F.array(*map(F.lit, weekday)))
    slots = F.flatten(F.transform(days, lambda d: F.transform(hours(d), lambda h: d.cast("timestamp") + F.make_dt_interval(hours=h))))
    return F.array_min(F.filter(slots, lambda t: t > local))


def run_label(state: Column) -> Column:
    """A scheduler's state as a label."""
    return F.when(state == "success", "SUCCESS").when(state.isin("failed", "upstream_failed"), "FAILED").when(state.isin("running", "queued"), "RUNNING").otherwise("SCHEDULED")


def transition(status: Column, event: Column) -> Column:
    """A ledger record's next status: done, failed, closed and rediscovered; what is closed stays so but for a rediscovery."""
    return F.when((status == "CLOSED") & (event == "rediscovered"), "PENDING").when(status == "CLOSED", "CLOSED").when(event == "closed", "CLOSED").when(event == "done", "DONE").when(event == "failed", "FAILED").otherwise(status)


def intro(lines: Column, headings: str, used: Column) -> Column:
    """Lines before the first heading that are no metadata and not used elsewhere."""
    at = F.array_position(F.transform(lines, lambda x: x.rlike(headings)), True)
    before = F.when(at > 0, F.slice(lines, 1, (at - 1).cast("int"))).otherwise(lines)
    return F.array_except(F.filter(before, lambda x: ~x.rlike(r"(?iu)^(?:lương|địa điểm|hạn nộp|salary|location|deadline)\s*:")), used)
