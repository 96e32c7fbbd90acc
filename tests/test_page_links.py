"""S18 against an HTML parser: for every <li> inside a <ul>, the href of its
first <a>. Brute force over all sf0.001 pages."""

from collections import Counter
from html.parser import HTMLParser

import pandas as pd

from tests.conftest import SF001
from vitalmart.plans.landing import page_links


class _Links(HTMLParser):
    """Open lists and open items on stacks; an <a> answers every open item
    that still waits for its first one."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.lists, self.items, self.open = [], [], []

    def handle_starttag(self, tag, attrs):
        if tag == "ul" or (tag == "ol" and self.lists):
            self.lists.append(tag)
        elif tag == "li" and self.lists:
            self.handle_endtag("li")
            self.items.append([])
            self.open.append((len(self.lists), self.items[-1]))
        elif tag == "a":
            for _, item in self.open:
                item.append(dict(attrs).get("href"))

    def handle_endtag(self, tag):
        if tag in ("ul", "ol") and tag in self.lists:
            while self.lists.pop() != tag:
                pass
            self.open = [o for o in self.open if o[0] <= len(self.lists)]
        elif tag == "li":
            self.open = [o for o in self.open if o[0] < len(self.lists)]

    @property
    def links(self):
        return [item[0] for item in self.items if item and item[0] is not None]


def test_links_match_an_html_parser(spark):
    pages = pd.read_parquet(f"{SF001}/pages.parquet", columns=["page_id", "html"])
    want = Counter()
    for pid, html in zip(pages.page_id, pages.html):
        p = _Links()
        p.feed(html)
        want.update((int(pid), h) for h in p.links)
    got = Counter((r.page_id, r.href) for r in page_links(spark, SF001).collect())
    assert got == want and sum(got.values()) > 0


def test_links_of_hand_made_pages(spark):
    from vitalmart.plans.landing import item_links
    pages = [
        ("<ul><li>text <b>x</b> <a href='/a'>a</a> <a href='/b'>b</a></li></ul>", ["/a"]),
        ('<UL CLASS="x>y"><LI><A ID=1 HREF="/c">c</A><LI><a href=/d>d</a></UL>', ["/c", "/d"]),
        ('<ol><li><a href="/e">e</a></li></ol><link href="/f"><a href="/g">g</a>', []),
        ('<ul><li><link href="/h"><abbr>i</abbr></li><li><a name="n">n</a><a href="/j">j</a></ul>', []),
        ('<ul><li><a href="/?a=1&amp;b=&quot;2&quot;">k</a></li></ul>', ['/?a=1&b="2"']),
        ('<ul><li><ul><li><a data-href="/l" href="/m">m</a></li></ul></li><li><a href="/n">n</a></li></ul>',
         ["/m", "/m", "/n"]),
        # the link after the inner list is the outer item's first; an inner item's only link is both items'
        ("<ul><li><ul><li>t</li></ul><a href='f'>f</a></ul>", ["f"]),
        ("<ul><li>a<ul><li><a href='g'>g</a><li><a href='h'>h</a></ul></li><li><a href='i'>i</a></li></ul>", ["g", "g", "h", "i"]),
        ("<ul><li><ol><li>x</li></ol><a href='j'>j</a></li></ul><li><a href='k'>k</a></li>", ["j"]),
        ("<ul><li><p title=\"<a href='z'>\">x</p><a href='y'>y</a></li></ul>", ["y"]),
        ("<ul><li><b title='</ul>'>x</b><a href='&#x2F;a&#47;&#x1F600;&#38;lt;&amp;#47;&#0;'>w</a></ul>", ["/a/\U0001F600&lt;&#47;\ufffd"]),
        ("<ul><li><a href='v'>v</a><a href='u'>u</a><li></ul></ul><li><a href='t'>t</a>", ["v"]),
        ('<!-- <ul><li><a href="/o">o</a> --><script>"<ul><li><a href=\'/p\'>"</script>', []),
        ("", []), (None, None)]
    df = spark.createDataFrame(list(enumerate(h for h, _ in pages)), "i int, html string")
    got = {r.i: r.links for r in df.select("i", item_links("html").alias("links")).collect()}
    assert [got[i] for i in range(len(pages))] == [want for _, want in pages]
