"""Scalar rules on names, texts and argument values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on: the syllables of aliases, and their prefix.
SYLLABLES = (
    "ba", "be", "bi", "bo", "bu", "ca", "ce", "ci", "co", "cu", "da", "de", "di", "do", "du", "fa", "fe", "fi", "fo", "fu",
    "ga", "ge", "gi", "go", "gu", "la", "le", "li", "lo", "lu", "na", "ne", "ni", "no", "nu", "ra", "re", "ri", "ro", "ru",
    "sa", "se", "si", "so", "su", "ta", "te", "ti", "to", "tu", "va", "ve", "vi", "vo", "vu",
)
ALIAS_PREFIX = "func_"

# The wording of questions, which rows must match.
QUESTION_AVAILABLE = "Given the available tools (with decoys), which one should the agent call next?"
QUESTION_PARAMS = "When calling {}, which parameters must be provided? (Select all that apply)"
QUESTION_VALUES = "For the call to {}, which parameter values are correct?"


def alias(name: Column, salt: Column, attempt: Column) -> Column:
    """A pronounceable name: three syllables from the SHA-1 of salt|name|attempt, and its last three digits."""
    h = F.sha1(F.concat_ws("|", salt, name, attempt.cast("string")).cast("binary"))

    def syllable(k: int) -> Column:
        return F.get(F.array(*map(F.lit, SYLLABLES)), F.conv(F.substring(h, 2 * k + 1, 2), 16, 10).cast("int") % len(SYLLABLES))

    return F.concat(F.lit(ALIAS_PREFIX), syllable(0), syllable(1), syllable(2), F.right(h, F.lit(3)))


def family(name: Column) -> Column:
    dash, under = F.split(name, "-"), F.split(name, "_")
    return (
        F.when(F.size(dash) >= 3, F.array_join(F.slice(dash, 1, 3), "-"))
        .when(F.size(dash) == 2, name)
        .when(F.size(under) >= 2, F.array_join(F.slice(under, 1, 2), "_"))
        .otherwise(name)
    )


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))


def profile(name: Column, description: Column) -> Column:
    """Tokens of a tool: of its description and of its name with dashes as spaces."""
    return F.array_union(tokens(F.coalesce(description, F.lit(""))), tokens(F.replace(name, F.lit("-"), F.lit(" "))))


def classify_string(v: Column) -> Column:
    low = F.lower(v)
    path = low.startswith("file://") | low.startswith("s3://") | v.contains("/") | v.contains("\\")
    words = F.size(F.filter(F.split(v, r"(?U)\s+"), lambda x: x != ""))
    return (
        F.when(low.startswith("http://") | low.startswith("https://"), "string:url")
        .when(path, "string:path_or_uri")
        .when(words >= 6, "string:long_text")
        .when(v.rlike(r"^\p{Nd}+$"), "string:numeric")
        .when(v.rlike(r"\p{Nd}") & v.rlike(r"\p{L}"), "string:alnum")
        .otherwise("string:general")
    )


def cluster_integer(v: Column) -> Column:
    n = F.length(F.abs(v).cast("string"))
    sign = F.when(v < 0, "number:negative").when(v == 0, "number:zero").otherwise("number:positive")
    size = F.when(n <= 1, "single_digit").when(n <= 2, "two_digits").when(n <= 4, "four_digits").when(n <= 8, "eight_digits").otherwise("huge")
    return F.concat_ws(":", sign, size)


def cluster_float(v: Column) -> Column:
    m = F.abs(v)
    return F.when(m == 0, "number:zero").when(m < 1, "number:fraction").when(m < 10, "number:small").when(m < 100, "number:medium").when(m < 1000, "number:large").otherwise("number:huge")


def cluster_label(p_type: Column, runtime: Column, text: Column, has_enum: Column, item_type: Column) -> Column:
    """Cluster of an argument from its type, its runtime type, its text and its schema."""
    whole = F.when(runtime == "boolean", F.when(text == "true", "1").otherwise("0")).otherwise(text)
    huge = F.concat_ws(":", F.when(whole.startswith("-"), "number:negative").otherwise("number:positive"), F.lit("huge"))
    integer = F.when(F.length(F.ltrim(F.lit("-"), whole)) > 18, huge).otherwise(cluster_integer(F.expr("0L") + whole.try_cast("long")))
    number = F.when(runtime.isin("integer", "boolean"), integer).when(runtime == "number", cluster_float(text.try_cast("double"))).otherwise("number:other")
    return (
        F.when(has_enum, "enum")
        .when(p_type.isin("integer", "number"), number)
        .when(p_type == "boolean", "boolean")
        .when(p_type == "array", F.concat(F.lit("array:"), F.coalesce(item_type, F.lit("any"))))
        .when(p_type == "object", "object")
        .when(p_type == "string", F.when(runtime == "string", classify_string(text)).otherwise("string:non_str"))
        .otherwise("unknown")
    )


def truncate(text: Column, limit: int) -> Column:
    if limit <= 0:
        return text
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, max(limit - 3, 0)), F.lit("...")))


def normalize_option(text: Column) -> Column:
    one = F.regexp_replace(F.trim(text), r"\s+", " ")
    return F.coalesce(F.regexp_replace(F.regexp_replace(one, r"\s*=\s*", "="), r"\s*;\s*", "; "), F.lit(""))


def json_block(text: Column) -> Column:
    """The first fenced JSON block, else what lies between the outermost braces, else null."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    bare = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(fenced != "", fenced).when(bare != "", bare)


def letter(position: Column) -> Column:
    """A to Z, then Option27 and so on, for positions from 0."""
    return F.when(position < 26, F.char(position + 65)).otherwise(F.concat(F.lit("Option"), (position + 1).cast("string")))


def payload_reason(question: Column, options: Column, answer: Column, canonical: Column) -> Column:
    """Why a generated question is refused; null if it is good.  Options are normalised texts."""
    norm = normalize_option(canonical)
    return (
        F.when(question.isNull() | (question == ""), "invalid_question")
        .when(options.isNull() | (F.size(options) == 0), "invalid_options")
        .when(~F.array_contains(F.transform(options, normalize_option), norm), "canonical_missing")
        .when(normalize_option(answer) != norm, "answer_mismatch")
    )


def rank_key(seed, *parts: Column) -> Column:
    """Replaces a random draw: the MD5 of the seed and what is drawn for and from."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(p.cast("string") for p in parts)).cast("binary"))
