from rxsieve.llm.line_dedup import host, page_lines, site_lines

SCHEMA = "page_id long, url string, html string"


def test_hosts(spark):
    urls = {"http://A.example/x": "a.example", "https://u:p@b.example:80/?q": "b.example", "c.example/x": "", None: "", "": "", "ftp://d#x": "d"}
    got = spark.createDataFrame([(u,) for u in urls], "url string").select("url", host("url").alias("h")).collect()
    assert {r.url: r.h for r in got} == urls


def test_lines_are_visible_text_between_blocks(spark):
    html = "<html><script>if (a<b) '</p>'</script><style>p{}</style><!-- no\nline --><p>One <b>two</b>&amp;lt; </p>\n<DIV class='x'>three<br/>four</div>  <li> </li>"
    got = spark.createDataFrame([(html,), (None,), ("",)], "html string").select(page_lines("html")).collect()
    assert [r[0] for r in got] == [["One two&lt;", "three", "four"], [], []]


def test_frequency_is_within_the_site(spark):
    pages = [(i, f"http://big.example/{i}", f"<p>menu</p><p>menu</p><p>page {i}</p><p>{'rare' if i < 3 else i}</p>") for i in range(30)]
    pages += [(100 + i, f"http://small.example/{i}", f"<p>menu</p><p>own {i}</p>") for i in range(2)]
    got = {r.page_id: r for r in site_lines(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert got[5].n_dropped == 2 and got[5].text == "page 5\n5" and got[5].n_lines == 4
    assert got[0].text == "page 0\nrare"  # on 3 of 30 pages: below the ratio
    assert got[100].text == "own 0"  # on both pages of its host
    alone = site_lines(spark.createDataFrame([(1, "http://one.example/", "<p>menu</p><p>menu</p>")], SCHEMA)).first()
    assert (alone.n_dropped, alone.text) == (0, "menu\nmenu")  # a single page tells nothing


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "http://x", "<p>a</p>"), (1, "http://x", "<p>a</p>"), (1, "http://x", "<p>a</p>"), (2, None, "z " * 50_000)]
    got = sorted(((r.page_id, r.n_lines, r.n_dropped) for r in site_lines(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([(None, 0, 0), (1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 0)], key=repr)
    assert site_lines(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, "http://x", "a", "h", "k")], SCHEMA + ", host string, lines string")
    assert site_lines(clash).first().text == "a"
