"""p2: pieces under a limit, cut at natural places."""

import random
import re

import pytest

from folioloom.llm import splitting as S

SCHEMA = "body_id long, html_content string, size_limit int, overlap int, title string, piece_no int"


def body(chapters=4, lines=6):
    out = []
    for c in range(1, chapters + 1):
        out.append(f"<h2>Chapter {c}</h2>")
        out += [f"<p>The grey river {c} turned under line {n}. It went on and on!</p>" for n in range(lines)]
    return "\n".join(out)


def bare(html):
    return re.sub(r"\s", "", S.visible(html))


@pytest.mark.parametrize("limit, overlap", [(200, 0), (200, 40), (333, 80), (60, 30), (10, 5), (7, 100)])
def test_pieces_rebuild_the_text(limit, overlap):
    text = body()
    pieces = S.split_text(text, limit, overlap)
    whole = ""
    for p in pieces:
        assert p.char_count == len(bare(p.html)) <= limit
        assert p.overlap == (min(overlap, limit - 1, pieces[p.piece_no - 2].char_count) if p.piece_no > 1 else 0)
        assert bare(p.html)[: p.overlap] == whole[len(whole) - p.overlap :]
        whole += bare(p.html)[p.overlap :]
    assert whole == bare(text)


def test_cuts_at_headings():
    pieces = S.split_text(body(4, 6), 320, 0)
    assert [p.title for p in pieces] == ["Chapter 1", "Chapter 2", "Chapter 3", "Chapter 4"]
    assert all(p.html.startswith("<h2>") for p in pieces)


def test_no_natural_place():
    pieces = S.split_text("x" * 1000, 300, 10)
    assert sum(p.char_count - p.overlap for p in pieces) == 1000 and max(p.char_count for p in pieces) <= 300


def test_headings():
    text = "\n".join(["<p>目录</p>", '<li><a href="#s1">第一回 灯火</a></li>', "<p>第一回　灯火</p>", "<p>且说第五回中，江水收起月色。</p>", "第2章", '<p class="t"><b>卷三 西风</b></p>', "【旧友】", "<p>Chapter IV had told how the river turned.</p>", "Chapter V. The River", "VI", "<p>三、店家</p>", "", "Preface"])
    assert S.heading_lines(text) == [2, 4, 5, 6, 8, 9, 10, 12]
    listed = "\n".join(["Contents", "Chapter 1", "Chapter 2", "Chapter 1", "It rained.", "Chapter 2", "It stopped."])
    assert S.heading_lines(listed) == [3, 5]


def plain_program(total, cuts, limit, overlap):
    """The least cost of cuts, every pair of places tried."""
    reach = limit - overlap
    even = total / (1 + max(1, -(-(total - limit) // reach)))
    places, fee = [0, *[p for p, _ in cuts], total], [0.0, *[f for _, f in cuts], 0.0]
    cost = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= (reach if i else limit):
                cost[j] = min(cost[j], cost[i] + fee[j] + S.BALANCE * ((places[j] - places[i] - even) / even) ** 2)
    return cost[-1]


def cost_of(chosen, total, cuts, limit, overlap):
    even = total / (1 + max(1, -(-(total - limit) // (limit - overlap))))
    marks, fees = [0, *chosen, total], dict(cuts)
    assert all(b - a <= (limit - overlap if a else limit) for a, b in zip(marks, marks[1:]))
    return sum(fees.get(b, 0.0) + S.BALANCE * ((b - a - even) / even) ** 2 for a, b in zip(marks, marks[1:]))


def test_cuts_are_the_best_ones():
    rng = random.Random(2)
    for _ in range(150):
        total, limit = rng.randint(50, 900), rng.randint(12, 200)
        overlap = rng.choice((0, rng.randint(0, limit - 1)))
        places = sorted({*rng.sample(range(1, total), min(total - 1, rng.randint(0, 60))), *range(limit - overlap, total, max(1, (limit - overlap) // 2))})
        cuts = [(p, rng.choice((0.0, 1.0, 3.0, 8.0))) for p in places]
        chosen = S.best_cuts(total, cuts, limit, overlap)
        wanted = plain_program(total, cuts, limit, overlap) if total > limit else 0.0
        if wanted < float("inf") and total > limit:
            assert abs(cost_of(chosen, total, cuts, limit, overlap) - wanted) < 1e-6


def test_long_headings_and_sections_without_text():
    long = "<h2>" + "The very long title of a chapter " * 4 + "</h2>"
    assert S.heading_lines("\n".join(["Part One", long, "It rained."])) == [0, 1]
    # a list of titles without a name of its own, its lines come again with text
    listed = "\n".join(["Chapter 1", "Chapter 2", "Chapter 3", "Chapter 1", "a b.", "Chapter 2", "c d.", "Chapter 3", "e f."])
    assert S.heading_lines(listed) == [3, 5, 7]
    assert S.heading_lines("\n".join(["I", "It rained.", "I", "It stopped."])) == [0, 2]


def test_the_sections_are_chosen_by_the_program(monkeypatch):
    listed = "\n".join(["Contents", "Chapter 1", "Chapter 2", "Chapter 1", "It rained.", "Chapter 2", "It stopped."])
    monkeypatch.setattr(S, "section_starts", lambda shapes, plain, prose: shapes)
    assert S.heading_lines(listed) == [1, 2, 3, 5]


def test_cut_lines_keep_their_tags():
    text = '<p>one <b>two <a href="x">three four</a> five</b> six &amp; seven<br/>eight</p>'
    pieces = S.split_text(text, 12, 0)
    assert "".join(bare(p.html) for p in pieces) == bare(text)
    for p in pieces:
        tags = re.findall(r"<(/?)(\w+)[^<>/]*(?:/)?>", p.html.replace("<br/>", ""))
        stack = []
        for close, name in tags:
            if close:
                assert stack.pop() == name
            else:
                stack.append(name)
        assert not stack and p.html.startswith("<p>") and p.html.endswith("</p>")
    assert any('<b>' in p.html and 'href="x"' in p.html for p in pieces) and "&amp;" in "".join(p.html for p in pieces)


def test_table(spark):
    text = body()
    rows = [(1, text, 200, 20, "x", 9), (1, text, 200, 20, "x", 9), (2, None, 200, 20, None, None), (3, "", 200, None, None, None), (4, "<p>short</p>", 200, None, None, None), (5, text, None, 3, None, None), (6, "y" * 50_000, 900, 50, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {tuple(r) for r in S.oversized_headings(df).collect()}
    assert found == {(1, 0), (1, 1), (1, 8), (1, 15), (1, 22), (6, 0)}
    pieces = S.split_bodies(df).collect()
    assert {p.body_id for p in pieces} == {1, 3, 4, 6}
    assert len([p for p in pieces if p.body_id == 1]) == max(p.piece_no for p in pieces if p.body_id == 1)
    assert S.split_bodies(df.limit(0)).count() == 0 and S.oversized_headings(df.limit(0)).count() == 0
