"""Text rules as column expressions: versioned normalisation, scripts, lines."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lathework.functions import codepoints
from lathework.shipping import ship

Rule = Callable[[Column], Column]

#: Code points that count as white space at the ends of a line, and full-width marks that stay.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
KEPT_MARKS = "！＂＇（），．：；？｛｝"
FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F) if chr(c) not in KEPT_MARKS)
HALF_WIDTH = "".join(chr(ord(c) - 0xFEE0) for c in FULL_WIDTH)
#: Bytes of an Arrow batch of texts.
BATCH_BYTES = 4 << 20
CLOSING, OPENING = "，。！？；：、）】》」』", "（【《「『"

#: Ranges of each script, in order of precedence. Latin is what Unicode names so.
SCRIPTS = {
    "Japanese": "3040-30FF 31F0-31FF",
    "Korean": "AC00-D7AF 1100-11FF",
    "CJK": "4E00-9FFF 3400-4DBF",
    "Latin": (
        "0041-005A 0061-007A 00C0-00D6 00D8-00F6 00F8-02AF 1D00-1D25 1D62-1D65 1D6B-1D77 1D79-1D9A 1E00-1EFF 2090-209C 2184-2184 271D-271D 2C60-2C7C "
        "2C7E-2C7F A722-A76F A771-A787 A78B-A7CA A7D0-A7D1 A7D3-A7D3 A7D5-A7D9 A7F5-A7F7 A7FA-A7FF AB30-AB5A AB60-AB64 AB66-AB68 FB00-FB06 1DF00-1DF1E 1DF25-1DF2A"
    ),
    "Arabic": "0600-06FF",
}


def script_class(name: str) -> str:
    """Character class of a script, in a form that both Java and RE2 read."""
    return "[" + "".join("\\x{" + a + "}-\\x{" + b + "}" for a, b in (r.split("-") for r in SCRIPTS[name].split())) + "]"


RULES: dict[str, Rule] = {}


def rule(name: str) -> Callable[[Rule], Rule]:
    """Registers a rule under a name; rules map a column to a column."""

    def add(f: Rule) -> Rule:
        RULES[name] = f
        return f

    return add


@rule("fullwidth_ascii")
def fullwidth_ascii(c: Column) -> Column:
    return F.translate(c, FULL_WIDTH, HALF_WIDTH)


@rule("ideographic_space")
def ideographic_space(c: Column) -> Column:
    return F.translate(c, "　", " ")


@rule("newlines")
def newlines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


@rule("whitespace")
def whitespace(c: Column) -> Column:
    return F.regexp_replace(c, "[ \t]+", " ")


@rule("punctuation_spacing")
def punctuation_spacing(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"[ \t]+([{CLOSING}])", "$1"), f"([{OPENING}])[ \t]+", "$1")


@rule("strip_lines")
def strip_lines(c: Column) -> Column:
    """Lines without blanks at their ends, and none that is blank: a run of blanks with a line feed in it is one."""
    blank = f"[{BLANKS}]"
    return F.btrim(F.regexp_replace(c, f"(?<!{blank})[{BLANKS}&&[^\n]]*+\n{blank}*+", "\n"), F.lit(BLANKS))


#: Rules of each version by language, in order; ``*`` serves languages without a list of their own.
VERSIONS: dict[str, dict[str, tuple[str, ...]]] = {
    "v1": {"*": ("fullwidth_ascii", "ideographic_space", "newlines", "whitespace", "punctuation_spacing", "strip_lines")},
}


def rules_of(version: str = "v1", language: str = "*") -> tuple[str, ...]:
    if version not in VERSIONS:
        raise ValueError(f"unknown normalisation version: {version}")
    return VERSIONS[version].get(language, VERSIONS[version]["*"])


#: The rules above over arrays, which cost a small part of the expressions.
KERNELS: dict[str, codepoints.Kernel] = {
    "fullwidth_ascii": codepoints.mapped(FULL_WIDTH, HALF_WIDTH),
    "ideographic_space": codepoints.mapped("\u3000", " "),
    "newlines": codepoints.newlines,
    "whitespace": codepoints.whitespace,
    "punctuation_spacing": codepoints.punctuation_spacing(CLOSING, OPENING),
    "strip_lines": codepoints.strip_lines(BLANKS),
}
OWN_RULES = dict(RULES)


def in_arrays(run: Callable, kind: str) -> Callable[[Column], Column]:
    """A function of Arrow arrays of text as a column function; batches are bounded by bytes."""
    spark, key = SparkSession.active(), "spark.sql.execution.arrow.maxBytesPerBatch"
    ship(spark)
    if int(str(spark.conf.get(key, "2147483647")).rstrip("bB") or 0) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    return lambda c: F.arrow_udf(run, kind)(c.cast("string"))


def kernels_of(names: tuple[str, ...]) -> dict[str, codepoints.Kernel] | None:
    """Kernels of rules, or none where one has only an expression."""
    return {n: KERNELS[n] for n in names} if all(n in KERNELS and RULES[n] is OWN_RULES[n] for n in names) else None


def normalize(c: Column, version: str = "v1", language: str = "*") -> Column:
    if not (kernels := kernels_of(names := rules_of(version, language))):
        return reduce(lambda x, name: RULES[name](x), names, c)

    def run(texts: pa.Array) -> pa.Array:
        return codepoints.normalized(texts, list(kernels.values()))

    return in_arrays(run, "string")(c)


def applied_rules(c: Column, version: str = "v1", language: str = "*") -> Column:
    """Names of the rules that changed the text, in order."""
    if kernels := kernels_of(names := rules_of(version, language)):

        def run(texts: pa.Array) -> pa.Array:
            return codepoints.changed_by(texts, kernels)

        return in_arrays(run, "array<string>")(c)
    hits, now = [], c
    for name in names:
        after = RULES[name](now)
        hits.append(F.when(~now.eqNullSafe(after), F.lit(name)))
        now = after
    return F.array_compact(F.array(*hits))


def detect_script(c: Column) -> Column:
    """First script of the precedence with a character in the text; ``Other`` without any."""
    out = F.lit("Other")
    for name in reversed(SCRIPTS):
        out = F.when(F.coalesce(c, F.lit("")).rlike(script_class(name)), name).otherwise(out)
    return out


def line_count(c: Column) -> Column:
    return F.size(F.split(c, "\n"))


def has_blank_line(c: Column) -> Column:
    return F.exists(F.split(c, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) == "")


def checkable_chars(c: Column) -> Column:
    """Distinct characters but for white space and control, format and unassigned ones."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"([^{BLANKS}\\p{{C}}])"), 1))
