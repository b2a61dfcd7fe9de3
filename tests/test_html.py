import time

import pytest
from pyspark.errors import PythonException

from tallyboard.sources.html_tables import award_rows, first_tables, parse_first_table

from .conftest import rows

PAGE = """
<table><thead><tr><th colspan="3">Voting</th><th>X</th></tr>
<tr><th>Rank</th><th>Player</th><th>Share</th><th>PTS</th></tr></thead>
<tbody><tr><td>1</td><td>Ann Example</td><td>0.915</td><td>27.1</td></tr>
<tr><td>10T</td><td>Bob Sample</td><td>0.003</td><td>20.0</td></tr></tbody></table>
<table><tr><th>Rank</th></tr><tr><td>99</td></tr></table>"""


def test_award_rows(make):
    pages = make([("https://example.org/awards/awards_2007.html", PAGE),
                  ("https://example.org/awards/awards_2000.html", PAGE.replace("Ann", "Cy"))], "url string, html string")
    assert rows(award_rows(pages)) == sorted([
        ("1", "Ann Example", 0.915, "2006-07"), ("10", "Bob Sample", 0.003, "2006-07"),
        ("1", "Cy Example", 0.915, "1999-00"), ("10", "Bob Sample", 0.003, "1999-00")], key=repr)


def test_short_rows_and_empty_cells_give_null(make):
    page = ("<table><tr><th>Rank</th><th>Player</th><th>Share</th></tr>"
            "<tr><td>1</td><td>A</td></tr><tr><td></td><td>B</td><td> </td></tr></table>")
    pages = make([("awards_2007", page)], "url string, html string")
    assert rows(award_rows(pages)) == sorted([("1", "A", None, "2006-07"), ("", "B", None, "2006-07")], key=repr)


def test_missing_tables(make):
    pages = make([("awards_2007", "<p>none</p>"), ("awards_2008", PAGE), ("awards_2009", "<table><tr><td>1</td></tr></table>"),
                  ("awards_2010", None)], "url string, html string")
    with pytest.raises(Exception, match="no table with"):
        award_rows(pages).collect()
    assert {r.award_season for r in award_rows(pages, on_missing="skip").collect()} == {"2007-08"}


def test_a_url_without_season_raises(make):
    with pytest.raises(Exception, match="no season in url"):
        award_rows(make([("awards.html", PAGE)], "url string, html string")).collect()


def test_bad_share_raises(make):
    pages = make([("awards_2007", PAGE.replace("0.915", "high"))], "url string, html string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        award_rows(pages).collect()


def test_share_with_thousands_separator(make):
    pages = make([("awards_2007", PAGE.replace("0.915", "1,234.5"))], "url string, html string")
    assert max(r.Share for r in award_rows(pages).collect()) == 1234.5


def test_keys_and_row_numbers(make):
    pages = make([(7, PAGE)], "id long, html string")
    assert rows(first_tables(pages, ["id"], ["PTS", "Rank"])) == [(7, 0, "27.1", "1"), (7, 1, "20.0", "10T")]


@pytest.mark.parametrize("html, header, body", [
    ("<TABLE><TR><TH>a<TH>b<TR><TD>1<TD>2</TABLE>", ["a", "b"], [["1", "2"]]),
    ("<!-- <table><tr><td>x</td></tr></table> --><table><tr><th>a</th></tr><tr><td>1</td></tr></table>", ["a"], [["1"]]),
    ("<script>'<table><tr><td>x'</script><table><tr><th>a</th></tr><tr><td>1</td></tr></table>", ["a"], [["1"]]),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td colspan=2>x &amp; y</td></tr></table>", ["a", "b"], [["x & y", "x & y"]]),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td rowspan='2'>x</td><td>1</td></tr><tr><td>2</td></tr></table>",
     ["a", "b"], [["x", "1"], ["x", "2"]]),
    ("<table><tr><th>a</th></tr><tr><td>p <table><tr><td>in</td></tr></table> q</td></tr></table>", ["a"], [["p in q"]]),
    ("<table><tr><th>a</th></tr><tr><td title='1>2'>l1<br>l2</td></tr></table>", ["a"], [["l1 l2"]]),
    ("<table><thead><tr><th>a</th></tr></thead><tr><th>1</th></tr></table>", ["a"], [["1"]]),
    ("<table><tr><th>a</th></tr><tr><td>1</td></tr>", ["a"], [["1"]]),
    ("<table></table>", [], []),
    ("<table style='display: none'><tr><td>x</td></tr></table><table><tr><th>a</th></tr><tr><td>1</td></tr></table>", ["a"], [["1"]]),
    ('<table><tr><th>a</th><th style="display:none">h</th></tr><tr style="DISPLAY:NONE"><td>0</td></tr><tr><td>1</td></tr></table>',
     ["a"], [["1"]]),
    ("<textarea><table><tr><td>x</textarea><table><tr><th>a</th></tr><tr><td>1</td></tr></table>", ["a"], [["1"]]),
    ("<title><table></title><STYLE><table></STYLE ><table><tr><th>a<tr><td>1<script>2</script>3</table>", ["a"], [["13"]]),
    ("<table><tr><th>a</th></tr><tr><td>1</td></tr><!-- <tr><td>2</td></tr></table>", ["a"], [["1"]]),
    ("<table><tr><th>a</th></tr><tr><td class=it's title=\"a>b\">1</td></tr></table>", ["a"], [["1"]]),
    ("<table><tr><th>a</th></tr><tr><td>1 < 2 <3</td></tr></table>", ["a"], [["1 < 2 <3"]]),
    ("<table><tr><th>a</th></tr><tr><td>1</td></tr></table", ["a"], [["1"]]),
    ("<table><tr><th>a</th></tr><tr><td>1<textarea>x<td>y", ["a"], [["1"]]),
])
def test_parse(html, header, body):
    assert parse_first_table(html) == (header, body)


def test_parse_without_table():
    assert parse_first_table("<p>text</p>") is None
    assert parse_first_table("</table><table style='display:none'><tr><td>x") is None


def test_wide_spans_are_followed_or_refused():
    header, body = parse_first_table("<table><tr><th>a</th><th colspan=1200>b</th><th>c</th></tr><tr><td>1</td></tr></table>")
    assert header == ["a"] + ["b"] * 1200 + ["c"] and body == [["1"]]
    with pytest.raises(ValueError, match="spans"):
        parse_first_table("<table><tr><th colspan=9999999>a</th></tr></table>")


@pytest.mark.parametrize("span", ["9999999", "9" * 5000])
def test_a_table_that_cannot_be_laid_out_is_left_out_or_named(make, span):
    rows = "<tr><th>a</th></tr><tr><td>%s</td></tr></table>"
    pages = make([(1, "<table>" + rows % "x"), (2, f"<table><tr><td colspan={span}>y</td></tr>" + rows % "y"), (3, None), (4, "<table>" + rows % "z")],
                 "page_id int, html string")
    found = first_tables(pages, ["page_id"], ["a"], on_missing="skip").collect()
    assert sorted(map(tuple, found)) == [(1, 0, "x"), (4, 0, "z")]
    with pytest.raises(PythonException, match=r"in page \[2\]"):
        first_tables(pages.where("page_id = 2"), ["page_id"], ["a"]).collect()


@pytest.mark.parametrize("markup", ["<td ", "<a href='x", "<!--", "<!-- x -->", "<script>", "<textarea>", "<a b=\"", "<a b='\"", "<", "</", "<b>", "<a x=",
                                    "<td>"])
@pytest.mark.parametrize("opening", ["", "<table><tr><td>"])
def test_broken_pages_take_linear_time(markup, opening):
    page = opening + markup * (1_000_000 // len(markup))
    start = time.process_time()
    parse_first_table(page)
    # A megabyte; rows of very many cells are held, so those take a little longer.
    assert time.process_time() - start < (1 if markup not in ("<td>", "<b>") else 5)
