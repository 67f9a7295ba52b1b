"""Provinces and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacatia.functions import terms as T
from vacatia.functions.core import let, record
from vacatia.functions.text import empty_to_null, fold, fold_py

_KEY_OF = {fold_py(n.removeprefix("TP. ")): k for k, names in T.PROVINCES.items() for n in names}
# street names that hold a province's name
_GUARD = {"hue": r"(?<!nguyen )hue", "dien bien": r"dien bien(?! phu)"}
_ANY = r"\b(" + "|".join(_GUARD.get(n, n) for n in sorted(_KEY_OF, key=lambda n: (-len(n), n))) + r")\b"
_LABEL = r"(?iu)^\s*(?:địa chỉ(?: trụ sở| làm việc| văn phòng)?|trụ sở(?: chính)?|văn phòng|address|office)\s*:\s*"
_DISTRICT = r"(?iu)^(?:quận|huyện|thị xã|q\.|h\.|tx\.)\s*\S"
_WARD = r"(?iu)^(phường|p\.|xã|đặc khu)\s*(.+)$"


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(pairs.items()) for x in kv])


def provinces(c: Column) -> Column:
    """Keys of the provinces that a text names, in order, each once; the longest name at a place counts."""
    return F.array_distinct(F.transform(F.regexp_extract_all(fold(c), F.lit(_ANY), F.lit(1)), lambda n: _map(_KEY_OF)[n]))


def province(c: Column) -> Column:
    """The last province that is named: addresses end with it."""
    return F.get(F.reverse(provinces(c)), F.lit(0))


def province_name(key: Column) -> Column:
    return F.try_element_at(_map({k: names[0] for k, names in T.PROVINCES.items()}), key)


def is_remote(c: Column) -> Column:
    return fold(c).rlike(r"\b(" + "|".join(fold_py(w) for w in T.REMOTE) + r")\b")


def is_abroad(c: Column) -> Column:
    return fold(c).rlike(r"\b(" + "|".join(fold_py(w) for w in T.ABROAD) + r")\b")


def address(c: Column) -> Column:
    """struct(street, ward, province, raw): districts and countries are dropped. Wards need a dictionary, so ward is NULL."""

    def parts_of(raw: Column) -> Column:
        line = F.coalesce(F.get(F.filter(F.split(raw, r"\r?\n"), lambda x: F.trim(x) != ""), F.lit(0)), F.lit(""))
        line = F.regexp_replace(F.regexp_replace(F.regexp_replace(line, r"\([^)]*\)?", " "), _LABEL, ""), r"^\s*[^,:\d]{2,30}?\s+:\s*", "")
        parts = F.filter(F.transform(F.split(line, r"[,|;]|\s+-\s+"), lambda p: F.btrim(p, F.lit(" ."))), lambda p: p != "")
        named = F.transform(parts, lambda p: record(part=p, folded=fold(p), province=province(p)))
        return record(raw=raw, named=named, gone=(raw == "") | fold(raw).isin("remote", "tu xa", "lam viec tu xa", "online"), anywhere=province(raw))

    def split(a: Column) -> Column:
        # the last part that names a province, and what stands before it
        at = F.coalesce(F.array_max(F.transform(a["named"], lambda p, i: F.when(p["province"].isNotNull(), i + 1))), F.lit(0))
        key = F.when(at > 0, F.get(a["named"], at - 1)["province"]).otherwise(a["anywhere"])
        before = F.filter(a["named"], lambda p, i: ((at == 0) | (i < at - 1)) & ~p["folded"].isin("viet nam", "vietnam", "vn") & ~p["part"].rlike(_DISTRICT) & ~p["part"].rlike(_WARD))
        street = F.array_join(F.transform(before, lambda p: p["part"]), ", ")
        return record(street=F.when(~a["gone"], empty_to_null(street)), ward=F.lit(None).cast("string"), province=F.when(~a["gone"], province_name(key)), raw=a["raw"])

    return let(F.trim(F.coalesce(c, F.lit(""))), lambda raw: let(parts_of(raw), split))


def locations(places: Column, text: Column, company: Column) -> Column:
    """Addresses of the first source that has any: the list of places, the posting's text, the company's address."""
    listed = F.filter(F.transform(places, lambda x: F.trim(x)), lambda x: x != "")
    one = lambda c: F.array(F.trim(c))
    source = F.when(F.size(listed) > 0, listed).when(F.trim(text) != "", one(text)).when(F.trim(company) != "", one(company)).otherwise(F.array().cast("array<string>"))
    return F.transform(source, address)
