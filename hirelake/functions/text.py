"""Text functions (H1-H4, H7-H13, I10, I17) as Column expressions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Latin-script term: a run of ASCII letters (what a tagger labels a foreign word).
LATIN_RUN = "[A-Za-z]+"
# --- FIXED VALUES: the characters that Python's str.split() and strip() take
# for white space; the regex class \s knows only the ASCII ones ---------------
WHITE = (r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# -----------------------------------------------------------------------------
# Hangul syllable run, the script of the Korean noun path.
HANGUL_RUN = "[가-힣]+"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def newline_to_space(c: ColumnOrName) -> Column:
    """H1: each LF becomes one space; runs are kept, NULL stays NULL."""
    return F.regexp_replace(_c(c), "\n", " ")


def clean_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """H1 over a column list in one projection."""
    return df.withColumns({c: newline_to_space(c) for c in cols})


def crlf_to_lf(c: ColumnOrName) -> Column:
    """H2."""
    return F.replace(_c(c), F.lit("\r\n"), F.lit("\n"))


def empty_to_null(c: ColumnOrName) -> Column:
    """H3."""
    return F.nullif(_c(c), F.lit(""))


def remove_spaces(c: ColumnOrName) -> Column:
    """H4: drop every ASCII space."""
    return F.replace(_c(c), F.lit(" "), F.lit(""))


def strip(c: ColumnOrName) -> Column:
    """Strip leading and trailing white space, of Unicode too."""
    return F.regexp_replace(_c(c), rf"\A{WHITE}+|{WHITE}+\z", "")


def split_ws(c: ColumnOrName) -> Column:
    """H8: whitespace tokens like Python's str.split(); blank gives []."""
    stripped = strip(c)
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, f"{WHITE}+"))


def prefix(c: ColumnOrName, n: int) -> Column:
    """H9: first n characters."""
    return F.substring(_c(c), 1, n)


def extract_id(c: ColumnOrName, pattern: str) -> Column:
    """First capture group of pattern, NULL when it does not match."""
    return F.nullif(F.regexp_extract(_c(c), pattern, 1), F.lit(""))


def script_runs(c: ColumnOrName, pattern: str = LATIN_RUN) -> Column:
    """Runs of a script class in order, repeats kept; NULL or blank -> []."""
    return F.coalesce(F.regexp_extract_all(_c(c), F.lit(pattern), 0),
                      F.array().cast("array<string>"))


def latin_terms(c: ColumnOrName) -> Column:
    """Latin-script terms of a text, ordered, repeats kept, blank -> []."""
    return script_runs(c, LATIN_RUN)


def clean_tags(c: ColumnOrName) -> Column:
    """Skill tags without '#', comment markers and surrounding white space."""
    return F.transform(
        _c(c),
        lambda x: strip(F.replace(F.replace(x, F.lit("#<!-- -->"), F.lit("")), F.lit("#"), F.lit(""))),
    )


# --- FIXED VALUES: posting URL formats of the four sites (H7) ----------------
URL_PREFIX = {
    "wanted": "https://www.wanted.co.kr/wd/",
    "jumpit": "https://www.jumpit.co.kr/position/",
    "rallit": "https://www.rallit.com/positions/",
    "jobplanet": "https://jobplanet.co.kr/job/search?posting_ids%5B%5D=",
}
# -----------------------------------------------------------------------------
PLATFORMS = ["wanted", "jumpit", "rallit", "jobplanet"]


def posting_url(platform: ColumnOrName, job_id: ColumnOrName) -> Column:
    """H7: the site's posting URL from platform and id; NULL for other sites."""
    p, j = _c(platform), _c(job_id).cast("string")
    expr = None
    for name, url in URL_PREFIX.items():
        branch = F.concat(F.lit(url), j)
        expr = F.when(p == name, branch) if expr is None else expr.when(p == name, branch)
    return expr


def html_text(c: ColumnOrName) -> Column:
    """Tag-free, entity-decoded, stripped text of an HTML fragment."""
    no_tags = F.regexp_replace(_c(c), "<[^>]*+>", "")
    decoded = no_tags
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return strip(decoded)
