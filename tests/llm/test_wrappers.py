from __future__ import annotations

import html as entities
import random
import re

from pyspark.sql import functions as F

from tidemark.llm import wrappers

from .conftest import SF_DIR, prose

SCHEMA = "page_id long, url string, html string"


def texts(df):
    return {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()}


def page(body, n=1, extra=""):
    return (f"<!DOCTYPE html><html><head><title>T {n}</title><style>p{{margin:0}}</style></head><body>"
            f"<header><h1>Site</h1></header><nav><ul>{'<li><a href=x>menu</a></li>' * (n % 4 + 1)}</ul></nav>{body}"
            f"{extra}<footer>&copy; site</footer></body></html>")


def test_given_pages(spark):
    """The article's blocks and nothing else; these pages mark the article."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = texts(pages)
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        plain = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in blocks]
        want = "\n".join(b for b in plain if b)
        assert re.sub(r" +", " ", got[r["page_id"]]) == want


def test_regions_are_left_out(spark):
    body = ("<article><h1>Head&amp;line</h1><p>One <b>bold</b>\n  two.</p><div class='ad-box'>BUY</div>"
            "<aside>side</aside><form><input value='q'>search</form><p>Three<br>four &lt;5&gt;"
            "<ul><li>item<li>other</ul><section id=comments><p>first!</p></section>"
            "<script>if (a < b) { '</p>' }</script><p>Last.</article><div class=\"related\"><p>More</p></div>")
    df = spark.createDataFrame([(1, "http://h.example/1", page(body, 1)), (2, "http://h.example/2", page(body, 2))], SCHEMA)
    want = "Head&line\nOne bold two.\nThree four <5>\nitem\nother\nLast."
    assert texts(df) == {1: want, 2: want}


def test_host_without_article_element(spark):
    """The container is the element that holds most ordinary text."""
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(12):
        paragraphs = [prose(rng, 40) for _ in range(rng.randrange(2, 6))]
        picture = "<figure><img src=x></figure>" if i % 3 == 0 else ""
        body = (f"<div id=top><span>Welcome</span></div><div id=story>{picture}"
                f"{''.join(f'<p>{p}</p>' for p in paragraphs)}</div><div id=rail><a href=y>link</a></div>")
        rows.append((i, f"https://Blog.example:80/{i}", page(body, i)))
        want[i] = "\n".join(paragraphs)
    assert texts(spark.createDataFrame(rows, SCHEMA)) == want


def test_many_structures_of_one_host(spark):
    """Every block of an article is kept, however many other structures its host has."""
    rng = random.Random(23)
    rows, want = [], {}
    word = lambda: f"w{rng.randrange(9999)}"
    for i in range(240):
        blocks, lines = ["<h1>#</h1>"], []
        for _ in range(rng.randrange(3, 14)):
            blocks.append(rng.choice([
                "<p>#</p>", "<p>#</p><p>#</p>", "<h2>#</h2>", "<h3>#</h3>", "<blockquote><p>#</p></blockquote>",
                "<ul><li>#</li><li>#</li></ul>", "<ol><li>#</li></ol>", "<figure><img src=x><figcaption>#</figcaption></figure>",
                "<aside class=related>!</aside>", "<div class=ad-box><p>!</p></div>", "<div class=box><p>#</p></div>",
                "<table><tr><td>#</td><td>#</td></tr></table>", "<section><h2>#</h2><p>#</p></section>", "<pre>#</pre>"]))
        body = "".join(blocks)
        while "#" in body:
            lines.append(word())
            body = body.replace("#", lines[-1], 1)
        body = body.replace("!", "advert")
        extra = rng.choice(["", "<div class=related><p>more</p></div>", "<section id=comments><p>first</p></section>"])
        rows.append((i, "http://h.example/", page(f"<article>{body}</article>", i, extra)))
        want[i] = "\n".join(lines)
    assert texts(spark.createDataFrame(rows, SCHEMA)) == want


def test_wrapper_has_optional_and_repeated_groups(spark):
    rows = [(i, "http://h.example/", page("<article>" + "<p>x</p>" * (i + 2) + ("<table><tr><td>1</table>" if i else "")
                                          + "</article>", 3)) for i in range(3)]
    row = wrappers.wrappers(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(row) == 1
    import json

    items = json.loads(row[0]["wrapper"])
    assert any(k == '["<p>", "#"]' for k, _, _ in items)
    assert any(k == "<table>" and optional for k, optional, _ in items)
    assert any(k == "<nav>" and not optional for k, optional, _ in items)


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "http://h.example/", ""), (3, "no address", "plain text only"),
            (4, "http://h.example/", "<article><p>un<b>closed"), (5, "http://h.example/", "<article"), (6, "x", "a < b & c"),
            (7, "http://h.example/", "<article>" + "<p>long text</p>" * 20000 + "</article>"), (None, None, "<p>x</p>"),
            (8, "http://g.example/", page("<article><p>same</article>")), (8, "http://g.example/", page("<article><p>same</article>"))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = wrappers.main_text(df)
    assert got.count() == len(rows) and got.columns == ["page_id", "url", "text", "n_chars"]
    by_id = texts(df)
    assert by_id[1] == "" and by_id[2] == "" and by_id[8] == "same" and by_id[4] == "unclosed"
    assert by_id[7] == "\n".join(["long text"] * 20000)
    assert got.filter("n_chars <> length(text)").count() == 0
    assert wrappers.main_text(df.limit(0)).count() == 0
    assert wrappers.main_text(df.withColumn("text", F.lit(1)).withColumn("wrapper", F.lit(2))).columns == [
        "page_id", "url", "wrapper", "text", "n_chars"]
