"""Pages as tokens: rules by hand, a comparison with the standard library's
parser on random pages, and pages with very many tags."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from hirelake.functions import html as h
from hirelake.operators import pages

DETAIL = ('<h1>site</h1><span class="css-kgsirb">#not this</span><section><p>banner</p></section><main>'
          '<h2 class="a css-17ueevk">Back<i>end</i> &amp; more</h2><div class="css-1vbiael"><section id=1><p>intro <b>text</b><p>second</section>'
          '<section><div class="css-15i1vgz"><div><p>w1</p></div><p>w2</p></div><div class="css-15i1vgz x"><ul><li>no paragraph</li></ul></div>'
          "<div class='css-15i1vgz'><p title=\"a > b\">pref<br>erred</p></div></section><section><p>third</p></section></div>"
          '<div class="css-104fbyc"><span class="css-kgsirb">\n#<!-- -->Spark </span><span class="css-kgsirb"><b>#SQL</b></span></div></main>')


def frame(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string")


def test_detail_page_by_class(spark):
    df = frame(spark, DETAIL, "", None, "<p>only", DETAIL.replace("css-1vbiael", "other").replace("css-104fbyc", "other"))
    got = {r["page_id"]: tuple(r)[1:] for r in pages.page_sections(df).collect()}
    none = (None,) * 6
    assert got == {0: ("Backend & more", "intro text", "w1", None, "preferred", None), 1: none, 2: none, 3: none,
                   4: ("Backend & more", *none[1:])}
    assert {r["page_id"]: r["tags"] for r in pages.skill_tags(df).collect()} == {0: ["Spark", "SQL"], 1: [], 2: [], 3: [], 4: []}
    assert {r["page_id"]: r["first_paragraph"] for r in pages.first_paragraphs(df).collect()} == {
        0: "banner", 1: None, 2: None, 3: "only", 4: "banner"}


def test_text_that_is_no_markup(spark):
    df = frame(spark, "<p>a < b <!-- <p>no</p> > --> c <script>if (a<b) x='</p>'</script>d</p>", "<style>p>a{}</style><p\nclass=x>y</p",
               "<p>it's <a href=x>l</a></p>", "<p title='<p>'>q</p>")
    got = [r["first_paragraph"] for r in pages.first_paragraphs(df).orderBy("page_id").collect()]
    assert got[:3] == ["a < b  c d", "y", "it's l"]


class Reader(HTMLParser):
    """Text of the first element of each class c0 to c4 by a stack."""

    def __init__(self):
        super().__init__()
        self.stack, self.text, self.done = [], {}, set()

    def handle_starttag(self, tag, attrs):
        if tag in h.VOID:
            return
        name = dict(attrs).get("class")
        first = name is not None and name not in self.text
        if first:
            self.text[name] = ""
        self.stack.append((tag, name if first else None))

    def handle_startendtag(self, tag, attrs):
        pass  # hr, empty

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        for _, name in self.stack:
            if name:
                self.text[name] += data


def random_page(rng, depth=0):
    out = ""
    for _ in range(rng.randint(0, 4)):
        tag = rng.choice(["div", "p", "section", "b", "ul"])
        mark = f' id="x" class="c{rng.randrange(5)}"' if rng.random() < 0.4 else ""
        inner = random_page(rng, depth + 1) if depth < 5 else ""
        out += f"w{rng.randrange(99)}<{tag}{mark}>{inner}t{rng.randrange(99)}</{tag}>" + rng.choice(["", "<br>", "<hr/>"])
    return out


def test_elements_equal_the_standard_parser(spark):
    rng = random.Random(8)
    made = [random_page(rng) for _ in range(200)]
    df = frame(spark, *made).select("page_id", h.tokens("html").alias("t"))
    got = df.select("page_id", *[h.text_of(h.first_element(F.col("t"), h.of_class(f"c{i}"))).alias(f"c{i}") for i in range(5)]).collect()
    for r in got:
        reader = Reader()
        reader.feed(made[r["page_id"]])
        assert {f"c{i}": reader.text.get(f"c{i}") for i in range(5)} == {f"c{i}": r[f"c{i}"] for i in range(5)}


def test_pages_with_very_many_tags(spark):
    n = 100_000
    inline = "<b>x</b>" * n
    detail = DETAIL.replace("w1", inline).replace("</ul>", "<li><a href='/positions/7'>x</a></li>" * n + "</ul>", 1)
    df = frame(spark, f"<p>{inline}</p>", detail, "<ul>" + f"<li>{'<i>' * 9}<a href=\"/positions/5\">x</a></li>" * (n // 10) + "</ul>",
               f'<div class="css-104fbyc">{"<span class=css-kgsirb>#t</span>" * n}</div>', "<!-- " + "<" * n + " --><p>y</p>" + "<" * n)
    assert [len(r["first_paragraph"] or "") for r in pages.first_paragraphs(df).orderBy("page_id").collect()] == [n, 6, 0, 0, 1]
    rows = {r["page_id"]: r for r in pages.page_sections(df).collect()}
    assert len(rows[1]["main_work"]) == n and rows[1]["preference"] == "preferred"
    assert pages.page_links(df).groupBy("page_id").count().orderBy("page_id").collect() == [(1, n), (2, n // 10)]
    assert {r["page_id"]: len(r["tags"]) for r in pages.skill_tags(df).collect()}[3] == n
