"""Text, URL and hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text hashed in place of a null so that keys equal those already stored.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def lower_trim(value) -> Column:
    return F.lower(F.trim(column(value)))


# The characters after which a new word starts, besides blanks.
WORD_BREAKS = r"""[](){}/|\<>!?@"^#$&~_,.:;*%+-"""


def title(value) -> Column:
    """First letter of each word upper case, the rest lower.

    Unlike ``initcap`` a word also starts after punctuation: ``york-CITY``
    becomes ``York-City``.
    """
    breaks = "".join("\\" + c for c in WORD_BREAKS)
    words = F.split(F.lower(column(value)), f"(?<=[\\s{breaks}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2)))), ""
    )


def title_trim(value) -> Column:
    return title(F.trim(column(value)))


def after(value, marker: str) -> Column:
    """Text after the first ``marker``; the whole text when there is none."""
    text = column(value)
    return F.substr(text, F.locate(marker, text) + F.lit(1))


def display_name(value) -> Column:
    """``home_decor`` becomes ``Home Decor``."""
    return title(F.replace(F.trim(column(value)), F.lit("_"), F.lit(" ")))


def flagged(pattern: str, flags: str = "") -> str:
    return f"(?{flags}){pattern}" if flags else pattern


def regex_position(value, pattern: str, position: int = 1, occurrence: int = 1, flags: str = "") -> Column:
    """1-based position of the n-th regex match at or after ``position``; 0 if there is none."""
    text, rx = column(value), F.lit(flagged(pattern, flags))
    start = F.lit(position)
    found = F.lit(0)
    for turn in range(occurrence):
        rest = F.substr(text, start)
        hit = F.regexp_instr(rest, rx)
        found = F.when(hit > 0, start + hit - 1).otherwise(F.lit(0))
        if turn + 1 < occurrence:
            width = F.greatest(F.length(F.regexp_extract(rest, flagged(pattern, flags), 0)), F.lit(1))
            start = F.when(found > 0, found + width).otherwise(F.length(text) + 1)
    return F.when(text.isNotNull(), found)


def _without_scheme(value, schemes: str) -> Column:
    return F.regexp_replace(column(value), schemes, "")


def url_host(value) -> Column:
    return F.regexp_extract(_without_scheme(value, "android-app://|https?://"), "^([^/?]*)", 1)


def url_path(value) -> Column:
    """Path without its leading slash and without the query."""
    rest = _without_scheme(value, "https?://")
    return (
        F.when(F.contains(rest, F.lit("/")), F.regexp_extract(rest, "^[^/]*/([^?]*)", 1))
        .when(F.contains(rest, F.lit("?")), F.lit(""))
        .otherwise(rest)
    )


def url_parameter(value, name: str) -> Column:
    """Value that follows the first ``name=``; null when absent or empty."""
    tail = F.split_part(column(value), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(tail, F.lit("&"), F.lit(1)), F.lit(""))


def surrogate_key(*names) -> Column:
    """md5 over the column texts, joined by a dash."""
    texts = [F.coalesce(column(n).cast("string"), F.lit(NULL_KEY_TEXT)) for n in names]
    return F.md5(F.concat_ws("-", *texts))


def masked_id(value, salt: str, digits: int = 12) -> Column:
    """Upper-case prefix of a salted SHA-256, for identifiers that must not be shown."""
    return F.upper(F.left(F.sha2(F.concat(F.lit(salt), column(value).cast("string")), 256), F.lit(digits)))
