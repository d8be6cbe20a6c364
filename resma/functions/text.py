"""Text scalars as column expressions; all stay inside code generation."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_letters(c: str) -> str:
    """A character case-folded, in compatibility decomposition (NFKD) and without combining marks."""
    return "".join(d for d in unicodedata.normalize("NFKD", c.casefold()) if not unicodedata.combining(d))


@functools.cache
def letter_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to, longer): characters that become one character, with these; those that vanish
    stand last in from. ``longer``: characters that become several. Built from the Unicode data;
    ideographs have no case or marks, and Korean syllables are left whole."""
    one: dict[str, str] = {}
    gone: list[str] = []
    longer: dict[str, str] = {}
    for n in (*range(0x20, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x11000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)):
        c = chr(n)
        to = plain_letters(c)
        if to == c:
            continue
        if len(to) == 1:
            one[c] = to
        elif to:
            longer[c] = to
        else:
            gone.append(c)
    return "".join(one) + "".join(gone), "".join(one.values()), longer


def squeeze(x: Column) -> Column:
    """All white space, also no-break spaces, as single spaces; none at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def unmojibake(x: Column) -> Column:
    """UTF-8 that was read as Latin-1, mended twice over; text that is no such case is kept."""
    for _ in range(2):
        # only text within Latin-1 can be turned back
        fits = x.rlike("[ÃÂ]") & ~x.rlike(r"[^\x{00}-\x{FF}]")
        mended = F.try_validate_utf8(F.encode(F.when(fits, x), "ISO-8859-1").cast("string"))
        x = F.coalesce(mended, x)
    return x


def without_marks(x: Column) -> Column:
    """Case-folded, in compatibility decomposition and without combining marks, inside code
    generation: a table of single letters, and for texts that hold a letter that becomes several
    (as the ligature fi does) a pass over their characters."""
    have, to, longer = letter_tables()
    # ß is frequent and no reason for the pass over all characters
    parts = F.replace(x, F.lit("ß"), F.lit("ss"))
    table = F.create_map(*[F.lit(v) for pair in longer.items() for v in pair])
    each = F.array_join(F.transform(F.split(parts, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    # most texts hold nothing beyond Latin letters, dashes and quotes, which a short class tells
    low, high = [ord(c) for c in longer if ord(c) < 0x180], [ord(c) for c in longer if ord(c) >= 0x180]
    several = parts.rlike(f"[{classed(low)}]") | (parts.rlike(r"[^\x{00}-\x{17F}\x{2010}-\x{2016}\x{2018}-\x{2022}]") & parts.rlike(f"[{classed(high)}]"))
    return F.translate(F.when(several, each).otherwise(parts), have, to)


def classed(points: list[int]) -> str:
    """Code points as ranges of a character class."""
    runs: list[list[int]] = []
    for n in sorted(points):
        if runs and runs[-1][1] == n - 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)


def normalized(x: Column) -> Column:
    """Mended, lower case, without marks, single spaces. Null stays null."""
    return squeeze(without_marks(unmojibake(x)))


def folded(x: Column) -> Column:
    return without_marks(x)


def title_words(x: Column) -> Column:
    """Words of a title or file name. A capital that begins a word inside a run of letters parts
    it there; all but letters and digits counts as white space."""
    parted = F.regexp_replace(F.regexp_replace(x, r"(\p{Ll})(\p{Lu})", "$1 $2"), r"(\p{Lu})(\p{Lu}\p{Ll})", "$1 $2")
    letters = F.translate(normalized(parted), "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()), " " * 32)
    return squeeze(F.regexp_replace(letters, "[^a-z0-9 ]", " "))


# What counts as a token of text, and least lengths.
TOKEN_LETTERS, TOKEN_DIGITS = 4, 5


def tokens(x: Column) -> Column:
    """The set of words (of TOKEN_LETTERS letters or more) and numbers (of TOKEN_DIGITS digits or
    more) of normalised text."""
    runs = F.regexp_extract_all(x, F.lit(f"[a-z]{{{TOKEN_LETTERS},}}|[0-9]{{{TOKEN_DIGITS},}}"), F.lit(0))
    return F.array_distinct(runs)


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def evidence(x: Column, patterns: dict[str, str]) -> Column:
    """Names of the ``patterns`` that text ``x`` holds, in their order."""
    return F.array_compact(F.array(*[F.when(x.rlike(p), F.lit(n)) for n, p in patterns.items()]))


# How many odd characters, at least and as a share of a text, tell that it was extracted badly.
ODD_SIGNS = {"replacement_characters": (10.0, 0.05), "unmapped_characters": (5.0, 0.02)}
#: A heading of so many characters with fewer letters and more odd signs than these shares is corrupt.
HEADING = (100, 0.15, 0.25)


def held(x: Column, characters: str) -> Column:
    """How many characters of the class ``characters`` a text has."""
    return F.length(x) - F.length(F.regexp_replace(x, characters, ""))


def text_faults(x: Column, heading: Column | None = None) -> Column:
    """Signs of text that was extracted badly: replacement_characters, unmapped_characters and,
    given the text of the page's ``heading``, corrupt_heading. Null text has none."""
    signs = {"replacement_characters": held(x, "\uFFFD"), "unmapped_characters": held(x, r"[\p{Co}\p{Cs}]")}
    told = [F.when(n > F.greatest(F.lit(ODD_SIGNS[k][0]), F.length(x) * ODD_SIGNS[k][1]), F.lit(k)) for k, n in signs.items()]
    if heading is not None:
        size, letters, odd = HEADING
        corrupt = (F.length(heading) > size) & (held(heading, r"\p{L}") < letters * F.length(heading)) & (held(heading, r"[^\p{L}\p{N}_\s.,:/()%-]") > odd * F.length(heading))
        told.append(F.when(corrupt, F.lit("corrupt_heading")))
    return F.array_compact(F.array(*told))


def printed_counter(x: Column, most: int = 60) -> Column:
    """The last printed page counter of a text, "2/7" or "2 de 7", as struct<page, of>: both
    numbers have one or two digits and lie between 1 and ``most``."""
    pair = r"\b([0-9]{1,2})\s*(?:/|de)\s*([0-9]{1,2})\b"
    pages, totals = (F.transform(F.regexp_extract_all(x, F.lit(pair), F.lit(g)), lambda n: n.cast("int")) for g in (1, 2))
    within = F.filter(F.arrays_zip(pages.alias("page"), totals.alias("of")), lambda c: c["page"].between(1, most) & c["of"].between(1, most))
    last = F.try_element_at(within, F.lit(-1))
    return F.when(last.isNotNull(), F.struct(last["page"].alias("page"), last["of"].alias("of")))


def url_fault(url: Column, host: str, path: str | None = None, parameter: str | None = None, value: Column | None = None, prefix: str | None = None) -> Column:
    """Why a URL is not one that is allowed, null if it is: malformed, scheme (https only), host,
    credentials, port (none or 443), fragment, path (equal to ``path``, or below ``prefix``),
    parameters (exactly one, named ``parameter``, with ``value`` or else of 1 to 128 letters, digits, _ and -)."""
    part = lambda name: F.try_parse_url(url, F.lit(name))
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    port = F.regexp_extract(authority, r":([0-9]*)\z", 1)
    rules = [
        ("malformed", part("PROTOCOL").isNotNull() & part("HOST").isNotNull()),
        ("scheme", F.lower(part("PROTOCOL")) == "https"),
        ("host", F.lower(part("HOST")) == host),
        ("credentials", ~authority.contains("@")),
        ("port", port.isin("", "443")),
        ("fragment", ~url.contains("#")),
    ]
    if path is not None:
        rules.append(("path", part("PATH") == path))
    if prefix is not None:
        rules.append(("path", part("PATH").startswith(prefix)))
    if parameter is not None:
        query = F.coalesce(part("QUERY"), F.lit(""))
        one = ~query.contains("&") & (F.substring_index(query, "=", 1) == parameter) & query.contains("=")
        given = F.try_url_decode(F.substring(query, len(parameter) + 2, 1 << 30))
        rules.append(("parameters", one & ((given == value) if value is not None else given.rlike(r"^[A-Za-z0-9_-]{1,128}\z"))))
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules])


def canonical_url(host: str, path: str, parameter: str, value: Column) -> Column:
    return F.concat(F.lit(f"https://{host}{path}?{parameter}="), F.url_encode(value))


def percentage(x: Column, missing: str = "inconcluso") -> Column:
    return F.when(x.isNull(), F.lit(missing)).otherwise(F.format_string("%.1f%%", x * 100))


def long_identifier(x: Column) -> Column:
    """Whether ``x`` is one long number with separators, such as 000.111-22."""
    return F.coalesce(x.rlike(r"^\d[\d./-]{6,}\z"), F.lit(False))


def disposition_name(x: Column) -> Column:
    """The file name of a Content-Disposition header: the extended form comes first; folders
    and control characters are dropped, at most 255 characters are kept. Null if there is none."""
    extended = F.try_url_decode(F.nullif(F.regexp_extract(x, r"(?i)filename\*\s*=\s*utf-8''([^;]+)", 1), F.lit("")))
    quoted = F.nullif(F.regexp_extract(x, r'(?i)filename\s*=\s*"([^"]*)"', 1), F.lit(""))
    bare = F.nullif(F.trim(F.regexp_extract(x, r"(?i)filename\s*=\s*([^\";]+)", 1)), F.lit(""))
    base = F.regexp_replace(F.coalesce(extended, quoted, bare), r"^.*[/\\]", "")
    return F.nullif(F.substring(F.regexp_replace(base, r"\p{Cntrl}", ""), 1, 255), F.lit(""))


def first_match(x: Column, patterns: dict[str, str], otherwise: str | None = None) -> Column:
    """The name of the first pattern that ``x`` holds."""
    return F.coalesce(*[F.when(x.rlike(p), F.lit(n)) for n, p in patterns.items()], F.lit(otherwise))
