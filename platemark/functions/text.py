"""Text expressions: normalisation, labels, codes, descriptions.

Patterns, and the order in which they are applied, are fixed values: results
depend on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spaced(text: Column) -> Column:
    """Blanks between words run together by case."""
    return F.regexp_replace(text, r"([a-z])([A-Z])", "$1 $2")


#: Blanks, decimal digits and digits of other kinds (raised, circled and the like), as the tools the rules come from take them.
BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BLANK_UI = r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
DIGIT = r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
#: What doesn't end a word for a sigma.
IGNORED = r"\p{Mn}\p{Me}\p{Cf}\p{Lm}\p{Sk}'.:\x{b7}\x{387}\x{55f}\x{5f4}\x{2018}\x{2019}\x{2024}\x{2027}\x{fe13}\x{fe52}\x{fe55}\x{ff07}\x{ff0e}\x{ff1a}"


def title_case(text: Column) -> Column:
    """Capitals after anything that has no case, small letters else; ``initcap`` only looks for blanks."""
    text = F.regexp_replace(text, rf"\x{{3a3}}(?=[{IGNORED}]*[{CASED}])", "\u03c3")
    pieces = F.regexp_extract_all(text, F.lit(rf"([{CASED}]+|[^{CASED}]+)"), 1)
    large = lambda p: F.upper(F.substring(p, 1, 1))
    # The A keeps a last sigma last; a capital of two letters, as of a sharp s, has only its first one large.
    small = lambda p: F.substr(F.lower(F.concat(F.lit("A"), F.substr(large(p), F.lit(2)), F.substr(p, F.lit(2)))), F.lit(2))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.substring(large(p), 1, 1), small(p))), "")


def humanize_title(text: Column) -> Column:
    """Words apart, blanks squeezed, title case."""
    t = F.regexp_replace(spaced(text), r"([A-Za-z])(\p{Nd})", "$1 $2")
    return title_case(F.trim(F.regexp_replace(t, BLANK + "+", " ")))


def humanize_label(text: Column) -> Column:
    """Words and digits apart; words of capitals only in small letters; then each word's first letter large."""
    t = F.regexp_replace(F.regexp_replace(spaced(text), r"([A-Za-z])([0-9])", "$1 $2"), r"([0-9])([A-Za-z])", "$1 $2")
    # Words are of ASCII letters here; Java's \b has others too.
    pieces = F.regexp_extract_all(F.regexp_replace(t, r"(?i)sign(?![A-Za-z0-9_])", "sign"), F.lit(r"([A-Za-z0-9_]+|[^A-Za-z0-9_]+)"), 1)
    calm = F.array_join(F.transform(pieces, lambda p: F.when(p.rlike("^[A-Z]{2,}$"), F.lower(p)).otherwise(p)), "")
    words = F.split(F.trim(F.regexp_replace(calm, BLANK_UI + "+", " ")), " ")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")


def valid_description(text: Column) -> Column:
    """At least three letters, and no more digits than letters."""
    letters, digits = F.length(F.regexp_replace(text, r"[^\p{L}]", "")), F.length(F.regexp_replace(text, rf"[^{DIGIT}]", ""))
    return F.coalesce((letters >= 3) & (digits <= letters), F.lit(False))


def normalize_line(line: Column) -> Column:
    """No-break blanks, runs of three or more spaced single letters closed up, tight points, and one blank after commas and around ampersands.

    The letter run has no word boundary, as the data it was made for needs.
    """
    t = F.replace(line, F.lit("\u00a0"), F.lit(" "))
    pieces = F.regexp_extract_all(t, F.lit(r"((?:[A-Za-z]\s+){2,}[A-Za-z]|(?s:.))"), 1)
    t = F.array_join(F.transform(pieces, lambda p: F.when(F.length(p) > 1, F.replace(p, F.lit(" "), F.lit(""))).otherwise(p)), "")
    for pattern, by in ((r"\s*\.\s*", "."), (r"\s*,\s*", ", "), (r"\s*&\s*", " & "), (r"\s+", " ")):
        t = F.regexp_replace(t, pattern, by)
    return F.trim(t)


def split_codes(part: Column) -> Column:
    """Codes of a list in free form: no brackets, ``and``, ``&``, ``;`` and ``,`` between, no blanks, capitals."""
    t = F.replace(F.replace(F.regexp_replace(part, r"[()]", ""), F.lit(" and "), F.lit(", ")), F.lit("&"), F.lit(", "))
    return F.filter(F.transform(F.split(t, "[;,]"), lambda c: F.upper(F.replace(F.trim(c), F.lit(" "), F.lit("")))), lambda c: c != "")


def code_key(code: Column) -> tuple[Column, Column]:
    """Natural order: the letters, then the rest without points as a number of up to 38 digits; null if it is none."""
    letters = F.regexp_replace(code, r"[^\p{L}]", "")
    rest = F.replace(F.substr(code, F.length(letters) + 1), F.lit("."), F.lit(""))
    return letters, F.when(rest.rlike("^[0-9]+$"), rest.try_cast("decimal(38,0)"))


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9_.-]", "_")


# Wordings where a label or a description is missing (fixed values).
NO_NUMBER, CODE_ONLY, UNLABELED = "UNK", "Code ", "Extracted sign (unlabeled)"


def fallback_label(page: Column, filename: Column, code: Column, description: Column) -> tuple[Column, Column]:
    """(label, description): the code, else page (or null) and running number; the description, else a phrase for it."""
    number = F.regexp_extract(F.coalesce(filename, F.lit("")), r"_([0-9]+)\.", 1)
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    label = F.when(~blank(code), code).otherwise(F.concat(F.lit("P"), F.coalesce(page.cast("string"), F.lit("null")), F.lit("-"), F.when(number != "", number).otherwise(NO_NUMBER)))
    text = F.when(~blank(description), description).when(~blank(code), F.concat(F.lit(CODE_ONLY), code)).otherwise(UNLABELED)
    return label, text
