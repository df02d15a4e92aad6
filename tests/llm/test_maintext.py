from __future__ import annotations

import random

import pytest

from proofline.llm import maintext as M
from proofline.llm.cascade import split_url


def page(parts, frame=("Home", "About us"), foot="All rights reserved"):
    top = "".join(f"<div>{x}</div>" for x in frame)
    return f"<html><head><title>t</title></head><body>{top}<div>{''.join(f'<p>{p}</p>' for p in parts)}</div><div>{foot}</div></body></html>"


def extracted(spark, rows, n=4):
    pages = spark.createDataFrame([(*r, 7, "x") for r in rows], "page_id long, url string, html string, n_chars int, shared string").repartition(n)
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in M.main_text(pages).collect()}


def length_by_force(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@pytest.mark.parametrize("kept", [1, 2, 3, 256])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, kept):
    monkeypatch.setattr(M, "ALIGNED_ROWS", kept)
    draw = random.Random(kept)
    for _ in range(600):
        signs = draw.choice([2, 4, 9])
        a, b = ([draw.randrange(signs) for _ in range(draw.randrange(14))] for _ in range(2))
        left, right = M.aligned(a, b)
        assert [x for x, here in zip(a, left) if here] == [x for x, here in zip(b, right) if here]
        assert left.sum() == length_by_force(a, b)


def test_marked_articles(spark):
    source = (
        "<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header>Site</header><nav><ul><li><a href='/'>Menu</a></li></ul></nav><!-- <p>note</p> --><div class='ad'>Buy</div>"
        "<article class='post with-sidebar'><header><h1>A &lt;title&gt; &eacute;&#233;</h1></header><p><b>One\n two<br>three<p>four&nbsp; five"
        "<form><p>sign up<input></form><aside>more</aside><p>six <span class='ad-slot'>ad</span>seven</p>"
        "<section id='comments'><p>first!</p></section></article><div class='cookie-notice'>Cookies</div><footer>&copy; me</footer>"
    )
    wanted = "A <title> éé\n\nOne two three\n\nfour five\n\nsix\n\nseven"
    assert extracted(spark, [(1, "http://a.example/x", source)]) == {1: (wanted, len(wanted))}


def test_frames_are_what_neighbours_share(spark):
    rows = [(i, f"https://site.example/news/{i:03}", page([f"Story {i}", f"It has {i} parts", "and so on" if i % 2 else f"end {i}"])) for i in range(40)]
    got = extracted(spark, rows)
    for i in range(40):
        assert got[i][0].split("\n\n")[:2] == [f"Story {i}", f"It has {i} parts"]
        assert "Home" not in got[i][0] and "rights" not in got[i][0]


def test_the_result_does_not_depend_on_partitions(spark, monkeypatch):
    draw = random.Random(5)
    rows = []
    for i in range(120):
        site = draw.randrange(4)
        parts = [f"text {draw.randrange(30)}" for _ in range(draw.randrange(6))]
        rows.append((i, f"http://h{site}.example/{'abc'[i % 3]}/{draw.randrange(50)}-{i}?q={i % 2}", page(parts, frame=(f"menu {site}", "Home"), foot=f"foot {site}")))
    once = extracted(spark, rows, 1)
    assert extracted(spark, rows[::-1], 7) == once == by_force(rows)
    monkeypatch.setattr(M, "CHUNK", 5)
    assert extracted(spark, rows, 3) == once


def by_force(rows):
    """Each page against the two before and after it in the order of its host."""
    order = sorted((*split_url(u), u, i) for i, u, _ in rows)
    lines = {i: M.lines_of(h) for i, _, h in rows}
    gone = {i: set() for i in lines}
    for at, (host, *_, i) in enumerate(order):
        for other, *_, j in order[at + 1 : at + 3]:
            if other != host:
                continue
            both = M.aligned(*([M._name(x) for x, _ in lines[k]] for k in (i, j)))
            sizes = [[len(x) * (s != M.FRAME) for x, s in lines[k]] for k in (i, j)]
            least = min(map(sum, sizes))
            if least and min(sum(n for n, h in zip(s, b) if h) for s, b in zip(sizes, both)) >= M.COPY * least:
                continue
            for k, here in zip((i, j), both):
                gone[k] |= {n for n, h in enumerate(here) if h and lines[k][n][1] == M.PLAIN}
    texts = {i: "\n\n".join(x for x, _ in M._kept([x for n, x in enumerate(lines[i]) if n not in gone[i]])) for i in lines}
    return {i: (t, len(t)) for i, t in texts.items()}


def test_copies_keep_their_text(spark):
    story = [f"A sentence number {k} that makes the story longer" for k in range(8)]
    rows = [(i, f"http://c.example/copy/{i}", page(story)) for i in range(6)]
    rows += [(10 + i, f"http://c.example/copy/{i}x", page([f"Other {i}", f"story {i * 7}"])) for i in range(6)]
    got = extracted(spark, rows)
    assert all(got[i][0] == "\n\n".join(story) for i in range(6))
    assert all(got[10 + i][0] == f"Other {i}\n\nstory {i * 7}" for i in range(6))


def test_odd_rows(spark):
    long = "<p>" + "word " * 200_000 + "</p>" + "<div>" * 5000
    rows = [
        (1, None, None), (2, "http://a.example/", ""), (3, "no host", "<p>x &amp y</p>"), (4, "http://a.example/", long), (None, None, "<p>q"),
        (6, "http://a.example/1", "<nav>only a menu"), (7, "http://a.example/2", "plain < text & more"), (7, "http://a.example/2", "plain < text & more"),
    ]
    got = extracted(spark, rows)
    assert got[1] == got[2] == got[6] == ("", 0)
    assert got[3] == ("x & y", 5) and got[None] == ("q", 1)
    assert got[4] == (" ".join(["word"] * 200_000), 999_999)
    assert got[7][0] == "plain < text & more"
    assert extracted(spark, []) == {}


def test_many_open_elements_take_no_square_of_time():
    for source in ('<a "' * 100_000, "<div>" * 100_000 + "x" + "</p>" * 100_000, "<b>" * 50_000 + "<p>x" * 1000):
        M.lines_of(source)
