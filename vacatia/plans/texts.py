"""Text, URL, JSON, date and money queries. Inputs without a table of their own are built from columns, alike in the SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.functions import classify, dates, money, places, text, urls
from vacatia.functions import terms as T
from vacatia.plans.registry import Queries, table

QUERIES = Queries()
Q = QUERIES.add

_STRIP = r"""nullif(array_to_string(list_filter(list_transform(string_split_regex(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?i)<\s*br\s*/?>|</\s*(?:p|li|tr|div)\s*>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '&(?:nbsp|#160|#xa0);', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t]+', ' ', 'g'), '\r?\n'), lambda x: trim(x)), lambda x: x <> ''), chr(10)), '')"""


@Q(f"select page_id, md5({_STRIP}) as digest, length({_STRIP}) as chars from pages")
def html_strip(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "pages", spread=True).select("page_id", text.strip_html(F.col("html")).alias("t"))
    return s.select("page_id", F.md5(F.col("t").cast("binary")).alias("digest"), F.length("t").cast("bigint").alias("chars"))


_VISIBLE = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?is)<noscript[^>]*>.*?</noscript>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"


@Q(rf"select page_id, sha256(trim(regexp_replace(regexp_replace(lower({_VISIBLE}), '\d+\s*(?:seconds?|minutes?|hours?|days?|weeks?|months?)\s+ago|\d+\s*views?', '', 'g'), '\s+', ' ', 'g'))) as digest from pages")
def html_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages", spread=True).select("page_id", urls.content_hash(F.col("html")).alias("digest"))


@Q(r"select page_id, trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)) as title, regexp_extract(html, '(?i)<html[^>]*lang=\"([^\"]*)\"', 1) as lang, len(regexp_extract_all(html, '(?i)<li[ >]'))::bigint as items from pages")
def page_fields(spark: SparkSession, d: str) -> DataFrame:
    h = F.col("html")
    return table(spark, d, "pages").select("page_id", F.trim(F.regexp_extract(h, r"(?is)<title>(.*?)</title>", 1)).alias("title"), F.regexp_extract(h, r'(?i)<html[^>]*lang="([^"]*)"', 1).alias("lang"), F.regexp_count(h, F.lit(r"(?i)<li[ >]")).cast("bigint").alias("items"))


@Q("select page_id, 'Posting ' || page_id as title, url from pages")
def jsonld_scripts(spark: SparkSession, d: str) -> DataFrame:
    """Postings out of JSON-LD scripts, also of @graph lists; other scripts and broken JSON are passed over."""
    from vacatia.sources.envelopes import postings

    posting = F.to_json(F.struct(F.lit("JobPosting").alias("@type"), F.concat(F.lit("Posting "), F.col("page_id").cast("string")).alias("title"), "url"))
    tag = '<script type="application/ld+json">'
    script = F.when(F.col("page_id") % 2 == 0, posting).otherwise(F.concat(F.lit('{"@graph":[{"@type":"Organization"},'), posting, F.lit("]}")))
    pages = table(spark, d, "pages").select("page_id", F.concat(F.lit(f"{tag}not json</script>{tag}"), script, F.lit("</script>"), "html").alias("html"))
    p = postings(pages, "page_id", "html")
    return p.select("page_id", F.expr("try_variant_get(posting, '$.title', 'string')").alias("title"), F.expr("try_variant_get(posting, '$.url', 'string')").alias("url"))


@Q("""select page_id, '{"n":' || page_id || '}' as state from pages""")
def next_data(spark: SparkSession, d: str) -> DataFrame:
    state = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">{"n":'), F.col("page_id").cast("string"), F.lit("}</script>"), "html")
    return table(spark, d, "pages").select("page_id", F.regexp_extract(state, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1).alias("state"))


@Q(r"select url, regexp_matches(url, '^[^:]+://[^/]+/[^/?#]+/\d+$') as is_job from pages")
def sitemap_urls(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "pages").select(F.concat(F.lit("<url><loc>"), "url", F.lit("</loc></url>")).alias("x"))
    locs = one.select(F.explode(F.regexp_extract_all("x", F.lit(r"<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("url"))
    return locs.select("url", F.col("url").rlike(r"^[^:]+://[^/]+/[^/?#]+/\d+$").alias("is_job"))


_PARAMS = r"list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.+') and not regexp_matches(p, '^(?:utm_|fbclid|gclid|ref|source|u_sr_id|ta_source|traceinfo)'))"
_CANON = rf"lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') || case when len({_PARAMS}) > 0 then '?' || array_to_string({_PARAMS}, '&') else '' end"


@Q(f"select page_id, {_CANON} as canonical from pages")
def canonical_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.canonical(F.col("url")).alias("canonical"))


@Q(f"select page_id, md5({_CANON}) as h, (('0x' || md5({_CANON})[1:8])::ubigint % 16)::int as shard from pages")
def url_hash_shard(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "pages").select("page_id", urls.url_hash(F.col("url")).alias("h"))
    return h.withColumn("shard", urls.shard(F.col("h"), 16))


@Q(r"select page_id, coalesce(nullif(regexp_extract(url, '(\d{6,})', 1), ''), nullif(regexp_extract(url, '/(\d+)\.html', 1), ''), md5(url)[1:12]) as job_id from pages")
def url_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.job_id(F.col("url")).alias("job_id"))


_WORDS = r"regexp_extract_all(trim(text), '[\p{L}\p{N}_][\p{L}\p{N}_.-]*[\p{L}\p{N}_]|[\p{L}\p{N}_]')"


@Q(rf"select doc_id, len({_WORDS})::bigint as words, length(trim(text))::bigint as chars, len(list_filter(string_split_regex(trim(text), '[.!?\n]+'), lambda x: trim(x) <> ''))::bigint as sentences, len({_WORDS}) < 30 as is_stub, coalesce(round(len(list_distinct(list_transform({_WORDS}, lambda x: lower(x)))) / len({_WORDS}), 3), 0) as ttr from documents")
def text_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "documents", spread=True).select("doc_id", text.metrics(F.col("text")).alias("m")).select("doc_id", "m.*")
    return m.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("words", "chars", "sentences")], "is_stub", "ttr")


@Q(rf"select source, lang, count(*) as kept, sum(len({_WORDS}))::bigint as words from documents where len({_WORDS}) >= 30 group by all")
def stub_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "documents", spread=True).withColumn("words", text.word_count(F.col("text"))).filter(F.col("words") >= T.MIN_WORDS)
    return kept.groupBy("source", "lang").agg(F.count("*").alias("kept"), F.sum("words").alias("words"))


def _markers(words: tuple[str, ...]) -> str:
    return " + ".join(f"contains(lower(text), '{w}')::int" for w in words)


@Q(f"select doc_id, case when vi >= 3 and en = 0 then 'vi' when en >= 3 and vi = 0 then 'en' when vi > 0 and en > 0 then 'bilingual' when regexp_matches(lower(text), '[{T.VI_LETTERS}]') then 'vi' else 'en' end as language from (select *, {_markers(T.VI_MARKERS)} as vi, {_markers(T.EN_MARKERS)} as en from documents)")
def language_markers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", spread=True).select("doc_id", text.language_by_markers(F.col("text")).alias("language"))


@Q(rf"select doc_id, case when len(regexp_extract_all(text, '\p{{L}}')) = 0 then 'vi' when len(regexp_extract_all(lower(text), '[{T.VI_LETTERS}]')) / len(regexp_extract_all(text, '\p{{L}}')) < 0.01 then 'en' else 'vi' end as language from documents")
def accent_ratio(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", spread=True).select("doc_id", text.language_by_letters(F.col("text")).alias("language"))


@Q(r"""with l as (select doc_id, generate_subscripts(x, 1) as i, unnest(x) as line from (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(s)), lambda s: s <> '') as x from documents)),
    f as (select *, (i = 1 or regexp_matches(line, '^\s*(?:[-–•*+▪▫➢]|\d+[.)])') or regexp_matches(lag(line) over (partition by doc_id order by i), '[.:;!]$'))::int as s from l),
    g as (select *, sum(s) over (partition by doc_id order by i) as k from f), items as (select doc_id, k, string_agg(line, ' ' order by i) as item from g group by all),
    o as (select doc_id, count(*) as n, string_agg(item, chr(10) order by k) as items from items group by doc_id)
    select d.doc_id, coalesce(n, 0)::int as n_items, coalesce(items, '') as items from documents d left join o using (doc_id)""")
def bullet_stitch(spark: SparkSession, d: str) -> DataFrame:
    items = text.stitch_bullets(F.split("text", "\n"))
    return table(spark, d, "documents", spread=True).select("doc_id", F.size(items).alias("n_items"), F.array_join(items, "\n").alias("items"))


@Q()
def clean_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.clean_lines(F.col("html")).alias("lines"))


@Q("select c_custkey, trim(regexp_replace(replace(lower(c_name), '#', ' '), '\\s+', ' ', 'g')) as company from customer")
def company_norm(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("Công ty TNHH "), "c_name", F.lit(" Việt Nam, JSC"))
    return table(spark, d, "customer").select("c_custkey", text.company_block(name).alias("company"))


@Q("select n_nationkey, trim(regexp_replace(lower(strip_accents(replace(n_name || ' Đà Nẵng C# & .NET', 'Đ', 'D'))), '[^a-z0-9]+', ' ', 'g')) as folded from nation")
def accent_fold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", text.fold(F.concat("n_name", F.lit(" Đà Nẵng C# & .NET"))).alias("folded"))


@Q("select p_partkey, replace(trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')), ' ', '_') || '_csharp' as slug from part")
def slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.slug(F.concat("p_type", F.lit(" C#"))).alias("slug"))


@Q("select p_partkey, p_name as title from part")
def title_clean(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("[HN/HCM] "), "p_name", F.lit(" - Lương "), F.col("p_size").cast("string"), F.lit("-60M"))
    return table(spark, d, "part").select("p_partkey", text.clean_title(raw).alias("title"))


@Q("""select o_orderkey, trim(regexp_replace(lower(o_orderpriority), '\\s+', ' ', 'g')) || '|' || o_custkey || '|ha_noi|' || case when o_orderdate is null then '' else isoyear(o_orderdate) || '-W' || lpad(week(o_orderdate)::varchar, 2, '0') end as dedup_key from orders""")
def dedup_key(spark: SparkSession, d: str) -> DataFrame:
    parts = [F.lower(text.collapse(F.col("o_orderpriority"))), F.col("o_custkey").cast("string"), places.province(F.concat("o_orderpriority", F.lit(", Cầu Giấy, Hà Nội"))), dates.iso_week(F.to_date("o_orderdate"))]
    return table(spark, d, "orders").select("o_orderkey", F.concat_ws("|", *parts).alias("dedup_key"))


def _salary_text() -> Column:
    r, n = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    more = (F.col("p_size") + 5).cast("string")
    j = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    return F.when(r == 0, j(n, " - ", more, " triệu")).when(r == 1, j("Từ ", n, " triệu")).when(r == 2, j("Up to ", n, ",000 USD")).when(r == 3, "Thỏa thuận").when(r == 4, j(n, "0.000.000 VND / năm")).otherwise(j(n, "00 - ", more, "00 USD"))


@Q("""select p_partkey, case p_partkey % 6 when 0 then p_size * 1e6 when 1 then p_size * 1e6 when 4 then p_size * 1e7 / 12 when 5 then p_size * 100 * 25400.0 end as low,
    case p_partkey % 6 when 0 then (p_size + 5) * 1e6 when 2 then p_size * 1000 * 25400.0 when 4 then p_size * 1e7 / 12 when 5 then (p_size + 5) * 100 * 25400.0 end as high, p_partkey % 6 = 3 as negotiable, case when p_partkey % 6 in (2, 5) then 'USD' else 'VND' end as currency from part""")
def salary_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", money.salary(_salary_text()).alias("s")).select("p_partkey", "s.low", "s.high", "s.negotiable", "s.currency")


@Q("""select p_partkey, case p_partkey % 4 when 0 then 'header' when 1 then 'title' when 2 then 'jd' else 'none' end as source, case p_partkey % 4 when 0 then (p_size + 1) * 1e6 when 1 then (p_size + 1) * 1e6 when 2 then (p_size + 1) * 1e6 end as low from part""")
def salary_cascade(spark: SparkSession, d: str) -> DataFrame:
    r, n = F.col("p_partkey") % 4, F.concat((F.col("p_size") + 1).cast("string"), F.lit("-"), (F.col("p_size") + 9).cast("string"), F.lit(" triệu"))
    header = F.when(r == 0, n).otherwise("Thỏa thuận")
    title = F.when(r == 1, F.concat(F.lit("Senior Java Dev ("), n, F.lit(")"))).otherwise("Mã tin 2026TD450981")
    description = F.when(r == 2, F.concat(F.lit("Mô tả công việc.\nThu nhập: "), n, F.lit("; thưởng"))).otherwise("Làm việc với 365 khách hàng")
    return table(spark, d, "part").select("p_partkey", money.salary_cascade(header, title, description).alias("s")).select("p_partkey", "s.source", "s.low")


@Q("""select p_partkey, case p_partkey % 5 when 0 then p_size::double when 1 then p_size::double when 2 then 0.0 when 3 then round(p_size / 12.0, 2) else 0.0 end as low, case p_partkey % 5 when 0 then p_size + 2.0 when 2 then p_size::double when 3 then round(p_size / 12.0, 2) when 4 then 0.0 end as high from part""")
def experience_parse(spark: SparkSession, d: str) -> DataFrame:
    r, n = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    t = F.when(r == 0, F.concat(n, F.lit(" - "), (F.col("p_size") + 2).cast("string"), F.lit(" năm"))).when(r == 1, F.concat(F.lit("Trên "), n, F.lit(" năm"))).when(r == 2, F.concat(F.lit("Dưới "), n, F.lit(" năm"))).when(r == 3, F.concat(n, F.lit(" tháng"))).otherwise("Không yêu cầu")
    return table(spark, d, "part").select("p_partkey", money.experience(t).alias("e")).select("p_partkey", "e.low", "e.high")


@Q("""select o_orderkey, case when o_orderkey % 4 = 3 then null else o_orderdate::date::varchar end as parsed, (o_orderkey % 4 <> 3 and o_orderdate::date < date '1997-01-01') as before_crawl from orders""")
def date_parse(spark: SparkSession, d: str) -> DataFrame:
    r, x = F.col("o_orderkey") % 4, F.col("o_orderdate")
    raw = F.when(r == 0, F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).when(r == 1, F.date_format(x, "dd/MM/yyyy")).when(r == 2, F.date_format(x, "yyyy/M/d")).otherwise("31/02/2026")
    p = table(spark, d, "orders").select("o_orderkey", dates.parse_date(raw).alias("p"))
    return p.select("o_orderkey", F.col("p").cast("string").alias("parsed"), F.coalesce(F.col("p") < F.lit("1997-01-01").cast("date"), F.lit(False)).alias("before_crawl"))


@Q("select p_partkey, coalesce(nullif(p_size % 7, 0), -1) as people from part")
def headcount_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.coalesce(money.headcount(F.concat(F.lit("Cần "), (F.col("p_size") % 7).cast("string"), F.lit(" người"))), F.lit(-1)).alias("people"))


_PLACES = (("1 Nguyễn Huệ, Quận 1", "", ""), ("Số 5 Điện Biên Phủ, TP. Hồ Chí Minh", "ho_chi_minh", "TP. Hồ Chí Minh"), ("Lô 3, KCN, Bà Rịa - Vũng Tàu", "ho_chi_minh", "TP. Hồ Chí Minh"), ("181 Trần Duy Hưng, Quận Cầu Giấy, Hà Nội, Việt Nam", "ha_noi", "TP. Hà Nội"), ("Remote", "", ""), ("Đà Nẵng; Huế", "hue", "TP. Huế"))


def _cases(column: str, values: tuple, n: str) -> str:
    return f"case {n} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


def _pick(values: tuple, n: Column) -> Column:
    out = F.when(n == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(n == i, v)
    return out


@Q(f"select c_custkey, {_cases('k', tuple(p[1] for p in _PLACES), 'c_custkey % 6')} as key, {_cases('p', tuple(p[2] for p in _PLACES), 'c_custkey % 6')} as province from customer")
def location_parse(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", _pick(tuple(p[0] for p in _PLACES), F.col("c_custkey") % 6).alias("t"))
    return c.select("c_custkey", F.coalesce(places.province(F.col("t")), F.lit("")).alias("key"), F.coalesce(places.address(F.col("t"))["province"], F.lit("")).alias("province"))


_TITLES = (
    # title, level, family, relevance
    ("Backend Developer", "Chưa rõ", "Backend", "it"), ("Intern QA", "Thực tập", "Kiểm thử (QA/QC)", "it"), ("Senior Data Engineer", "Senior", "Data/AI", "it"),
    ("International Sales", "Chưa rõ", "Khác", "non_it"), ("Kế toán trưởng", "Chưa rõ", "Khác", "non_it"), ("IT Recruiter", "Chưa rõ", "Khác", "unknown"),
    ("Engineering Manager", "Trưởng nhóm/Quản lý", "Khác", "unknown"), ("Fresher Flutter", "Mới tốt nghiệp", "Mobile", "it"),
)


@Q(f"select p_partkey, {_cases('l', tuple(t[1] for t in _TITLES), 'p_partkey % 8')} as level, {_cases('f', tuple(t[2] for t in _TITLES), 'p_partkey % 8')} as family, {_cases('r', tuple(t[3] for t in _TITLES), 'p_partkey % 8')} as relevance from part")
def title_rules(spark: SparkSession, d: str) -> DataFrame:
    title = _pick(tuple(t[0] for t in _TITLES), F.col("p_partkey") % 8)
    none = F.array().cast("array<string>")
    p = table(spark, d, "part").select("p_partkey", title.alias("t"))
    return p.select("p_partkey", classify.level(F.lit(None).cast("string"), F.col("t"), F.lit(None).cast("double"))["level"].alias("level"), classify.family(F.col("t"), none)["family"].alias("family"), classify.relevance(F.col("t"), none).alias("relevance"))


@Q("""with p as (select p_partkey, p_partkey % 3 as r, (p_size % 14) / 2.0 as y from part)
    select p_partkey, case when r = 0 then 'Senior' when r = 1 then 'Thực tập' when y = 0 then 'Mới tốt nghiệp' when y between 1 and 2 then 'Junior' when y between 3 and 4 then 'Middle' when y >= 5 then 'Senior' else 'Chưa rõ' end as level,
        (r = 0 and y < 2) or (r = 1 and y >= 3) as conflict from p""")
def seniority_by_years(spark: SparkSession, d: str) -> DataFrame:
    """The title decides, else the years, which leave gaps between the bands; and whether title and years go together."""
    none, years = F.lit(None).cast("string"), (F.col("p_size") % 14) / 2.0
    title = _pick(("Senior Developer", "Intern", "Chuyên viên"), F.col("p_partkey") % 3)
    p = table(spark, d, "part").select("p_partkey", years.alias("y"), classify.level(none, title, years).alias("l"))
    return p.select("p_partkey", F.col("l.level").alias("level"), classify.level_conflict(F.col("l.level"), F.col("y"), F.col("y")).alias("conflict"))


_TYPES = (("Toàn thời gian", "full_time"), ("PART TIME", "part_time"), ("Internship", "intern"), ("Thời vụ", "other"))


@Q(f"select o_orderkey, coalesce({_cases('t', tuple(t[1] for t in _TYPES), 'o_orderkey % 5')}, 'missing') as kind from orders")
def employment_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", classify.employment(_pick(tuple(t[0] for t in _TYPES), F.col("o_orderkey") % 5)).alias("kind"))


_NULLS = ((" N/A ", "TEXT_PLACEHOLDER"), ("0", "NUMERIC_ZERO"), ("  ", "WHITESPACE_ONLY"), ("Thỏa thuận", "NEGOTIABLE_MARKER"), ("[]", "EMPTY_CONTAINER"), ("NaN", "EXPLICIT_NAN"), ("Java", "VALID"))


@Q(f"select kind, is_null, count(*) as n from (select coalesce({_cases('n', tuple(t[1] for t in _NULLS), 'event_id % 8')}, 'EXPLICIT_NONE') as kind, event_id % 8 <> 6 as is_null from events) group by all")
def null_kinds(spark: SparkSession, d: str) -> DataFrame:
    c = _pick(tuple(t[0] for t in _NULLS), F.col("event_id") % 8)
    return table(spark, d, "events").select(classify.null_kind(c).alias("kind"), classify.is_null(c).alias("is_null")).groupBy("kind", "is_null").agg(F.count("*").alias("n"))


@Q("""select p_partkey, case p_partkey % 3 when 0 then 'C#,Docker,Node.js,Python' when 1 then 'Java,SQL' else '' end as skills, case p_partkey % 3 when 0 then 'Bảo hiểm,Du lịch' when 1 then 'Lương tháng 13' else '' end as benefits from part""")
def skills_and_benefits(spark: SparkSession, d: str) -> DataFrame:
    r, none = F.col("p_partkey") % 3, F.array().cast("array<string>")
    jd = F.when(r == 0, "Python, NodeJS và C#; Docker. BHXH, company trip").when(r == 1, "Spring Boot + PostgreSQL; lương tháng 13").otherwise("Giao hàng tận nơi, gogo")
    return table(spark, d, "part").select("p_partkey", F.array_join(classify.skills_in_text(jd), ",").alias("skills"), F.array_join(classify.benefits(none, jd), ",").alias("benefits"))


@Q("""select p_partkey, 'ReactJS,Java,' || p_brand as kept, 'React,Java,' || p_brand as canonical from part""")
def skill_tags(spark: SparkSession, d: str) -> DataFrame:
    tags = F.array(F.lit(" ReactJS"), F.lit("Java"), F.lit("java"), F.lit("Việc làm IT"), F.lit("Lập trình viên"), F.col("p_brand"), F.lit("một hai ba bốn năm"), F.lit("ABC Soft tuyển"))
    kept = classify.tag_skills(tags, F.lit("ABC Soft"))
    return table(spark, d, "part").select("p_partkey", F.array_join(kept, ",").alias("kept"), F.array_join(classify.canonical(kept), ",").alias("canonical"))


@Q("select p_partkey, 'quyền lợi và đãi ngộ: ' || p_name || ' làm việc từ xa' as vi from part")
def to_vietnamese(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.to_vietnamese(F.concat(F.lit("Benefits: "), "p_name", F.lit(" remote"))).alias("vi"))


@Q("select event_id, (props->>'$.k')::bigint as k, sha256(props->>'$.k') as field_hash, sha256('{\"k\":\"' || (props->>'$.k') || '\"}') as canonical_hash from events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    fields = F.from_json("props", "map<string,string>")
    e = table(spark, d, "events").select("event_id", fields.alias("f"))
    volatile = F.map_concat("f", F.create_map(F.lit("scraped_at"), F.lit("now")))
    return e.select("event_id", F.col("f")["k"].cast("bigint").alias("k"), urls.field_hashes(F.col("f"))["k"].alias("field_hash"), urls.canonical_json_hash(volatile, ("scraped_at",)).alias("canonical_hash"))


@Q("""select o_orderkey, (o_orderstatus = 'F' or o_orderdate < timestamp '1996-01-01' or contains(lower(o_orderpriority), 'low')) as closed from orders""")
def closed_postings(spark: SparkSession, d: str) -> DataFrame:
    ref = F.lit("1996-01-01").cast("timestamp_ntz")
    closed = (F.col("o_orderstatus") == "F") | (F.col("o_orderdate") < ref) | F.contains(F.lower("o_orderpriority"), F.lit("low"))
    return table(spark, d, "orders").select("o_orderkey", closed.alias("closed"))


@Q("""select o_orderkey, strftime(o_orderdate + interval 7 hour, '%Y-%m-%d %H:%M') as local_time, isodow(o_orderdate + interval 7 hour) >= 6 as weekend from orders""")
def local_time(spark: SparkSession, d: str) -> DataFrame:
    at = dates.local(F.col("o_orderdate").cast("timestamp"))
    return table(spark, d, "orders").select("o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm").alias("local_time"), F.dayofweek(at).isin(1, 7).alias("weekend"))


@Q("""select o_orderkey, strftime(o_orderdate, '%Y%m%d') || '_' || lower(o_orderstatus) || '_' || lpad((o_orderkey % 1000)::varchar, 3, '0') as batch_id, regexp_replace(reverse(regexp_replace(reverse((floor(o_totalprice)::bigint * 1000)::varchar), '(\\d{3})', '\\1.', 'g')), '^\\.', '') as shown from orders""")
def display_values(spark: SparkSession, d: str) -> DataFrame:
    shown = F.translate(F.format_number(F.floor("o_totalprice") * 1000, 0), ",", ".")
    return table(spark, d, "orders").select("o_orderkey", F.format_string("%s_%s_%03d", F.date_format("o_orderdate", "yyyyMMdd"), F.lower("o_orderstatus"), F.col("o_orderkey") % 1000).alias("batch_id"), shown.alias("shown"))
