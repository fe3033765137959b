"""HTML pages as token arrays (I14-I17), with built-in expressions only.

A page is cut at every ``<`` into tokens; each holds a tag (lower-case name,
whether it closes, its attributes) and the text behind it. Elements are found
by folding over the tokens with a state of fixed size (open tags of the
element's name so far, where it ended), so the work follows the number of
tokens, nothing is matched by a backtracking expression over the page, and a
page may hold any number of tags. One page is one row; nothing is shuffled.

Defined cases: comments, scripts and styles are no text; a ``<`` that starts
no tag is text; a tag that never closes runs to the end of what is searched;
void and self-closed tags are empty; attribute values may hold ``>`` but a
``<`` in one cuts the tag there; a paragraph ends at the next ``<p>`` or
``</p>``; NULL pages have NULL tokens and NULL results.

Keep tokens in a column of their own before calling the functions that take a
token column: they read it several times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import html_text

# --- FIXED VALUES: elements of HTML that have no content ----------------------
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
# -----------------------------------------------------------------------------
NO_TEXT = r"(?is)<!--.*?-->|<(script|style)(?:\s[^>]*+)?>.*?</\1\s*+>"
TAG_NAME = r"^/?([A-Za-z][A-Za-z0-9:-]*+)"
#: The rest of a tag up to its end, quoted values first, then any.
TAG_END = r"""^(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
TAG_END_LOOSE = r"^[^>]*+>"
ATTRIBUTE = r"""(?is)\s{}\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""


def attribute(head: Column, name: str) -> Column:
    """Value of an attribute in a tag, '' where it has none."""
    pattern = ATTRIBUTE.format(name)
    return F.concat(*[F.regexp_extract(head, pattern, i) for i in (1, 2, 3)])


def tokens(html: Column | str) -> Column:
    """array<struct<name, close, single, head, classes, text>> of a page."""
    page = F.col(html) if isinstance(html, str) else html
    parts = F.split(F.regexp_replace(page, NO_TEXT, ""), "<", -1)
    cut = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda x: F.struct(
        x.alias("x"), F.lower(F.regexp_extract(x, TAG_NAME, 1)).alias("name"),
        F.coalesce(F.nullif(F.regexp_extract(x, TAG_END, 0), F.lit("")), F.regexp_extract(x, TAG_END_LOOSE, 0)).alias("head")))

    def token(t: Column) -> Column:
        x, name, head = t["x"], t["name"], t["head"]
        markup = (name != "") | x.startswith("!") | x.startswith("?") | x.startswith("/")
        behind = F.when(~markup, F.concat(F.lit("<"), x)).when(head == "", "").otherwise(F.substr(x, F.length(head) + 1))
        spaced = F.concat(F.lit(" "), F.regexp_replace(attribute(head, "class"), r"\s+", " "), F.lit(" "))
        return F.struct(name.alias("name"), x.startswith("/").alias("close"),
                        (name.isin(VOID) | head.endswith("/>")).alias("single"), head.alias("head"),
                        F.when(F.contains(head, F.lit("=")), spaced).otherwise("").alias("classes"), behind.alias("text"))

    return F.transform(cut, token)


def named(*names: str) -> Callable[[Column], Column]:
    return lambda t: t["name"].isin(*names)


def of_class(name: str) -> Callable[[Column], Column]:
    return lambda t: F.contains(t["classes"], F.lit(f" {name} "))


def _positions(toks: Column, test: Callable[[Column], Column]) -> Column:
    at = F.transform(toks, lambda t, i: F.when(test(t), i + 1))
    return F.filter(at, lambda i: i.isNotNull())


def starts(toks: Column, test: Callable[[Column], Column]) -> Column:
    """Positions (from 1) of the opening tags that pass the test, in order."""
    return _positions(toks, lambda t: ~t["close"] & test(t))


def element(toks: Column, at: Column) -> Column:
    """The tokens of the element that opens at a position, without its closing
    tag; NULL where the position is."""
    zero = F.struct(F.lit(0).alias("n"), F.lit("").alias("name"), F.lit(0).alias("open"), F.lit(-1).alias("end"))

    def step(s: Column, t: Column) -> Column:
        name = F.when(s["n"] == 0, t["name"]).otherwise(s["name"])
        more = F.when((t["name"] != name) | t["single"], 0).when(t["close"], -1).otherwise(1)
        end = F.when(s["end"] >= 0, s["end"]).when(s["open"] + more <= 0, s["n"]).otherwise(-1)
        return F.struct((s["n"] + 1).alias("n"), name.alias("name"), (s["open"] + more).alias("open"), end.alias("end"))

    size = F.aggregate(F.slice(toks, at, F.size(toks)), zero, step,
                       lambda s: F.when(s["end"] >= 0, s["end"]).otherwise(s["n"]))
    return F.slice(toks, at, size)


def first_element(toks: Column, test: Callable[[Column], Column], n: int = 1) -> Column:
    """The n-th element that passes the test, in the order of opening tags."""
    return element(toks, F.get(starts(toks, test), F.lit(n - 1)))


def text_of(toks: Column) -> Column:
    """Tag-free, entity-decoded, stripped text of tokens."""
    return html_text(F.array_join(F.transform(toks, lambda t: t["text"]), ""))


def first_paragraph(toks: Column) -> Column:
    """Text of the first paragraph among tokens; NULL when there is none."""
    at = F.get(starts(toks, named("p")), F.lit(0))
    behind = F.transform(F.slice(toks, at + 1, F.size(toks)), lambda t: t["name"])
    stop = F.array_position(behind, "p").cast("int")
    return text_of(F.slice(toks, at, F.when(stop == 0, F.size(toks)).otherwise(stop)))


def _spans(at: Column, size: Column) -> Column:
    """array<struct<at, n>>: from each position to before the next, or the end."""
    after = F.slice(at, F.lit(2), F.size(at))
    return F.zip_with(at, after, lambda a, b: F.struct(a.alias("at"), (F.coalesce(b, size + 1) - a).alias("n")))


def spans(toks: Column, test: Callable[[Column], Column]) -> Column:
    """Spans between all tags, opening or closing, that pass the test."""
    return _spans(_positions(toks, test), F.size(toks))


def opening_spans(toks: Column, test: Callable[[Column], Column]) -> Column:
    """Spans from each opening tag that passes the test to the next such."""
    return _spans(starts(toks, test), F.size(toks))
