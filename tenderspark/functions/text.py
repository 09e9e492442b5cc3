"""Column expressions for text: folding, hashing, tokens, tolerant parsing and Brazilian formats. All native."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderspark.functions.fixed import CONFIDENCE, GROUP_RULES, STOP_WORDS, UNITS

@cache
def _folding() -> tuple[str, str, dict[str, str]]:
    """One-to-one compatibility foldings from U+00A0 to U+25FF, and the few Latin ones that give several letters."""
    one, to, many = [], [], {}
    for cp in range(0xA0, 0x2600):
        ch = chr(cp)
        flat = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if flat != ch and len(flat) == 1:
            one.append(ch)
            to.append(flat)
        elif len(flat) > 1 and flat.isalpha() and cp < 0x250:
            many[ch] = flat.lower()
    return "".join(one), "".join(to), many | {"ﬁ": "fi", "ﬂ": "fl"}


def fold(c: Column) -> Column:
    """Lower case without accents."""
    one, to, many = _folding()
    low = F.lower(c)
    c = F.translate(low, one, to)
    some = c.rlike("[" + "".join(many) + "]")
    spelled = c
    for ch, flat in many.items():
        spelled = F.replace(spelled, F.lit(ch), F.lit(flat))
    return F.when(low.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.when(some, spelled).otherwise(c), r"\p{M}+", "")).otherwise(low)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_text(c: Column) -> Column:
    """Folded, white space collapsed; null gives the empty string."""
    return F.coalesce(squeeze(fold(c)), F.lit(""))


def norm_term(c: Column) -> Column:
    """Lower case with accents kept, white space collapsed; null gives the empty string."""
    return F.coalesce(squeeze(F.lower(c)), F.lit(""))


def text_hash(description: Column, unit: Column) -> Column:
    return F.sha1(F.concat_ws("|", norm_text(description), norm_text(unit)))


def row_hash(description: Column, name: Column) -> Column:
    return F.md5(F.concat(F.coalesce(description, F.lit("")), F.coalesce(name, F.lit(""))))


def tokenize_alnum(c: Column) -> Column:
    return F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit("[0-9a-z]+"), F.lit(0))


def tokenize_catalog(c: Column) -> Column:
    """Tokens with a number and its unit joined, of two characters or more, without stop words; raw ones if none is left."""
    joined = F.regexp_replace(norm_text(c), rf"([0-9])\s+({'|'.join(UNITS)})\b", "$1$2")
    raw = F.filter(F.split(F.regexp_replace(joined, "[^0-9a-z]+", " "), " "), lambda t: F.length(t) >= 2)
    good = F.filter(raw, lambda t: ~t.isin(*STOP_WORDS))
    return F.when(F.size(good) > 0, good).otherwise(raw)


def category_of_group(name: Column) -> Column:
    """The category that a group's name stands for, by the first rule that it holds; else null."""
    folded, out = norm_text(name), F.lit(None).cast("string")
    for part, category in reversed(GROUP_RULES):
        out = F.when(folded.contains(part), category).otherwise(out)
    return out


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def parse_number_br(c: Column) -> Column:
    """With a comma, dots are thousands; else a plain number; what is neither gives null."""
    t = F.trim(c)
    return F.when(t.contains(","), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(t).try_cast("double")


def parse_decimal(c: Column, kind: str = "decimal(18,4)") -> Column:
    return blank_to_null(c).try_cast(kind)


def parse_text(c: Column) -> Column:
    """Trimmed; blank gives null."""
    return blank_to_null(c)


def quantity_text(c: Column) -> Column:
    """A quantity as the text of a double (1.0, 2420.0); null gives the empty string, what is no number stays."""
    return F.coalesce(c.cast("string").try_cast("double").cast("string"), c.cast("string"), F.lit(""))


def parse_int(c: Column) -> Column:
    """An integer, by truncation of a decimal text."""
    return blank_to_null(c).try_cast("double").try_cast("bigint")


def parse_date(c: Column) -> Column:
    return F.try_to_date(F.substring(F.trim(c), 1, 10), "yyyy-MM-dd")


def parse_timestamp(c: Column) -> Column:
    """ISO with at most six digits of the fraction used; a bare date is its midnight."""
    t = F.regexp_replace(F.regexp_replace(F.trim(c), "T", " "), r"(\.[0-9]{6})[0-9]+", "$1")
    return F.coalesce(t.try_cast("timestamp"), parse_date(c).cast("timestamp"))


def format_money_br(c: Column) -> Column:
    """1234.5 -> 1.234,50; null gives the empty string."""
    return F.coalesce(F.translate(F.format_number(c, 2), ",.", ".,"), F.lit(""))


def price_variants(c: Column) -> Column:
    """The two spellings of a positive price, else none."""
    grouped = format_money_br(c)
    return F.when(c > 0, F.array_distinct(F.array(F.replace(grouped, F.lit("."), F.lit("")), grouped))).otherwise(F.array().cast("array<string>"))


def format_date_br(c: Column) -> Column:
    """dd/MM/yyyy; a text that is no date stays, null gives the empty string."""
    return F.coalesce(F.date_format(parse_date(c), "dd/MM/yyyy"), c, F.lit(""))


def validity_end(kind: Column, end: Column, signed: Column) -> Column:
    """A contract ends a year after its signature; whatever else, kind unknown too, has its own end."""
    return F.when(F.lower(kind) == "contract", F.add_months(signed, 12)).otherwise(end)


CONTROL = r"^([0-9]{14})-([0-9]+)-([0-9]+)/([0-9]{4})(?:-([0-9]+))?$"


def parse_control_number(c: Column) -> Column:
    """struct(cnpj, kind, seq, year, act_seq) of ``cnpj-kind-seq/year[-act]``, leading zeros dropped, blanks around it
    too; else null."""
    c = F.trim(c)
    part = lambda i: F.regexp_extract(c, CONTROL, i)
    return F.when(c.rlike(CONTROL), F.struct(part(1).alias("cnpj"), part(2).alias("kind"), part(3).cast("long").alias("seq"), part(4).cast("int").alias("year"), F.nullif(part(5), F.lit("")).cast("long").alias("act_seq")))


def document_url(control: Column, kind: Column, base: str) -> Column:
    """Addresses under ``base``: a contract's, an act's, or for an act without a sequence that of its purchase; an
    unknown form gives the empty string."""
    p = parse_control_number(control)
    contract = F.coalesce(F.lower(kind) == "contract", F.lit(False))
    part = F.when(contract, "contratos").when(p["act_seq"].isNull(), "editais").otherwise("atas")
    stem = F.concat_ws("/", F.lit(base), part, p["cnpj"], p["year"].cast("string"), p["seq"].cast("string"), F.when(~contract, p["act_seq"].cast("string")))
    return F.when(p.isNull(), "").otherwise(stem)


def purchase_seq(control: Column) -> Column:
    return parse_control_number(control)["seq"]


def head_noun(description: Column, name: Column) -> Column:
    """What stands before the first comma of the description; without a comma the name, and without a name the description."""
    whole = F.coalesce(blank_to_null(name), description, F.lit(""))
    return F.trim(F.when(F.coalesce(description, F.lit("")).contains(","), F.substring_index(description, ",", 1)).otherwise(whole))


def item_key(document: Column, number: Column) -> Column:
    return F.concat_ws("::", document.cast("string"), number.cast("string"))


pair_key = item_key


def split_pair_key(c: Column) -> Column:
    parts = F.split(c, "::", 2)
    return F.struct(parts[0].alias("code"), F.try_element_at(parts, F.lit(2)).alias("item_key"))


def confidence_ordinal(c: Column) -> Column:
    t = F.lower(F.trim(c))
    rule = t.try_cast("double")
    for word, value in CONFIDENCE.items():
        rule = F.when(t == word, F.lit(value)).otherwise(rule)
    return rule


def parse_model_json(c: Column, schema: str) -> Column:
    """The struct in the outermost braces of a model's answer; null where it does not parse."""
    return F.from_json(F.regexp_extract(c, r"(?s)\{.*\}", 0), schema)


def parse_yes_no(c: Column) -> Column:
    """The answer 'sim' or 'nao', whatever its case, accents and what follows."""
    t = norm_text(c)
    return F.when(t.startswith("sim"), "yes").when(t.startswith("nao"), "no").otherwise("error")


def parse_label_pipe(c: Column, labels: list[str]) -> Column:
    """struct(label, reason) of ``LABEL|reason``; without a bar the first word is the label and all of it the reason; an
    unknown label is ``error`` with the answer's first 120 characters."""
    t = F.trim(F.coalesce(c, F.lit("")))
    barred = t.contains("|")
    name = F.when(barred, F.trim(F.substring_index(t, "|", 1))).otherwise(F.split(t, r"\s+")[0])
    name = F.regexp_replace(norm_text(name), r"[.,;:]+$", "")
    known = name.isin(*labels)
    said = F.when(barred, F.trim(F.try_element_at(F.split(t, r"\|", 2), F.lit(2)))).otherwise(t)
    return F.struct(F.when(known, name).otherwise("error").alias("label"), F.when(known, said).otherwise(F.substring(t, 1, 120)).alias("reason"))


def page_density(c: Column) -> Column:
    """Characters of a page without those around its text; null has none."""
    return F.length(F.trim(F.coalesce(c, F.lit(""))))


def is_scanned(c: Column, least: int = 100) -> Column:
    return page_density(c) < least


def strip_nul(c: Column) -> Column:
    return F.translate(c, "\u0000", "")


def split_pipe(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
