"""The tree helper against brute force."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from webcorpus.sources.markup import PageNodes

PIECES = st.sampled_from(
    "<p> </p> <b> </b> <div> </div> <nav> </nav> <a> </a> <ul> <li> </ul> <table> <tr> <td> </table> <br> <svg/> "
    "<script>var</script> <html> <body> </body> <head> </head> <title>t</title> <!--c--> foo bar x&amp;y é < & "
    "<blockquote> </blockquote> <pre> </pre> <h1> </h1> <video> </video> <main>".split(" ")
    + [" ", "\n"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECES, max_size=40))
def test_invariants(pieces):
    page = PageNodes().feed("".join(pieces))
    n = len(page.tag)
    assert len({len(getattr(page, a)) for a in page.__slots__[:14]}) == 1
    for i in range(n):
        up = page.parent[i]
        assert -1 <= up < i <= page.end[i] < n
        if up >= 0:
            assert page.end[i] <= page.end[up] and page.tag[up] != "#text"
            assert page.killed[i] or not page.killed[up]
        below = range(i, page.end[i] + 1)
        text = "".join(page.text[j] for j in below if page.text[j] and not page.killed[j])
        assert page.words[i] == len(re.findall(r"\w+", text))
        assert page.links[i] == sum(page.tag[j] == "a" and not page.killed[j] for j in below if j != i)


def test_linear_on_hostile_input():
    for html in ("<b>" * 100_000, "<p><b>" * 30_000, "<a href='" * 30_000, "<!--" * 50_000, "<div " * 50_000, "<ul><li>" * 30_000):
        PageNodes().feed(html)
