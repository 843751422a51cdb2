"""p5: structure blocks of mixed markup."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioloom.llm import markup, markup_blocks

CASES = [
    ("<h2 class=q><i>The River</i></h2>", [("heading", "The River")]),
    ("&lt;h3&gt;The Drowsy Pocket&lt;/h3&gt;", [("heading", "The Drowsy Pocket")]),
    ("### Scholar and the **Rabbit** ###", [("heading", "Scholar and the Rabbit")]),
    ("==== ''The Brittle Night''====", [("heading", "The Brittle Night")]),
    ("A Title\n=======\n", [("heading", "A Title")]),
    ("\\subsection*{Letter beyond the \\emph{Valley}}", [("heading", "Letter beyond the Valley")]),
    ("<ul>\n<li>one</li>\n<LI><p>two  three</p></LI>\n</ul>", [("list_item", "one"), ("list_item", "two three")]),
    ("* one\n*two\n- three\n+ four\n# five\n#six\n1. seven", [("list_item", x) for x in "one two three four five six seven".split()]),
    ("\\begin{itemize}\n  \\item one\n\\end{itemize}", [("list_item", "one")]),
    ("```text\na = 1\nb = 2\n```", [("code", "a = 1 b = 2")]),
    ("~~~\nx\n~~~", [("code", "x")]),
    ("<pre><code>if a &lt; b\nstop</code></pre>", [("code", "if a < b stop")]),
    ("&lt;pre&gt;\nreturn 1\n&lt;/pre&gt;", [("code", "return 1")]),
    ('<syntaxhighlight lang="text">let t = 1</syntaxhighlight>', [("code", "let t = 1")]),
    ("\\begin{lstlisting}\nx\n\\end{lstlisting}", [("code", "x")]),
    ("$$ a^2 + b^2 $$", [("formula", "a^2 + b^2")]),
    ("\\[ x \\]\n\\(y\\)", [("formula", "x"), ("formula", "y")]),
    ('<p><span class="math">\\(s = 2 \\pi r\\)</span></p>', [("formula", "s = 2 \\pi r")]),
    ("<math>v = d / t</math>", [("formula", "v = d / t")]),
    ("\\begin{equation}\nt \\le 40\n\\end{equation}", [("formula", "t \\le 40")]),
    ("* * *\n---\n<hr/>\n<p>* * *</p>", []),
    ("He paid $5 and then $7 for it. It came to 100 # of tea.", []),
    ("*Each* river ran.\n**Each** stone lay.", []),
    ("Plain prose.\n\nMore prose.", []),
]


@pytest.mark.parametrize("text, wanted", CASES)
def test_blocks(text, wanted):
    blocks, lines = markup.split_blocks(text)
    assert [(b.kind, b.text) for b in blocks] == wanted
    assert len(lines) == text.count("\n") + 1


def test_inline():
    assert markup.clean_inline("a [[Note 15|b]] [[c]] [d](#n1) '''e''' ''f'' {\\it g} \\textbf{h} _i_ `j` <b>k</b>") == "a b c d e f g h i j k"


def test_clean_text():
    text = "<nav>x</nav>\n## Head\n" + "<p>" + "The long river went on. " * 8 + "</p>\n- item\n$$ x^2 $$"
    assert markup.clean_text(text).split("\n")[0] == "# Head"
    assert "- item" in markup.clean_text(text) and "$$ x^2 $$" in markup.clean_text(text)
    assert markup.clean_text(None) is None and markup.clean_text("") == ""


def body(*lines):
    return markup.body_lines(markup.line_sizes("\n".join(lines)))


def test_line_sizes():
    assert markup.line_sizes("<p>a b</p>\n* * *\n\n<b\n>x1</b>\n字字") == [2, 0, 0, 0, 2, 6]


def test_body_lines():
    assert body("menu", "", "", "", "", "", "x" * 100, "y" * 100, "", "", "", "foot") == [False] * 6 + [True, True] + [False] * 4
    assert body("Chapter 1", "", "x" * 100) == [True] * 3  # a short line next to the surge
    assert body("", "* * *") == [False, False] and body() == [False]


def test_blocks_come_from_the_body_only():
    text = "- Home\n- Top\n\n\n\n\n\n\n## One\n" + "<p>" + "The long river went on. " * 8 + "</p>\n- item\n\n\n\n\n## Share"
    assert [b.text for b in markup.structure(text)[0]] == ["One", "item"]
    assert [b.text for b in markup.structure(text, distribution=False)[0]] == ["Home", "Top", "One", "item", "Share"]
    code = "\n\n\n\n<pre>\n\n\n\n\n" + "let x = 1; " * 20 + "\n</pre>"
    assert [b.kind for b in markup.structure(code)[0]] == ["code"]  # a block counts if one of its lines is body


ENGLISH = "<p>The long river went on past the mill, and nobody in the village could say where it ended or why.</p>"
CHINESE = "<p>西风的木箱在后院，送来了少年。茶馆寻到雪地，江水便走过店家。</p>"


@pytest.mark.parametrize("paragraph", [ENGLISH, CHINESE, "<p>It rained.</p>", "<p>雨后，少年想起村口。</p>"])
@pytest.mark.parametrize("between", ["\n", "\n\n", "\n\n# One\n#two\n#three\n#four\n\n", "\n\n```\na\n\n\n\nb\n```\n\n", "\n\n\n\n\n"])
def test_no_paragraph_of_a_chapter_is_lost(paragraph, between):
    inner = markup.squeeze(markup.clean_inline(paragraph))
    for text in (between.join([paragraph] * 3), ENGLISH + between + paragraph + between + paragraph):
        lines = markup.clean_text(text).split("\n")
        assert lines.count(inner) >= 2 and sum(line.endswith((".", "。")) for line in lines) == 3


def test_structure_is_neutral_and_menus_still_go():
    assert body("x" * 100, "", "- item", "", "verse of the song") == [True] * 5
    assert body("x" * 100, "", "", "", "verse") == [True, False, False, False, False]
    assert markup.clean_text("Home\n\n\n\n\n\n" + ENGLISH + "\n\n\n\nTop").split("\n") == [ENGLISH[3:-4]]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab *#=$\\[](){}<>&;`~-_'\n1.|/hlipre", max_size=200))
def test_never_raises_and_keeps_lines(text):
    blocks, lines = markup.split_blocks(text)
    assert len(lines) == text.count("\n") + 1
    assert all(b.text == markup.squeeze(b.text) and b.text for b in blocks)
    markup.clean_text(text)


def test_tables(spark):
    schema = "part string, id string, text string, block_kind string"
    df = spark.createDataFrame([("c", "a", "## H\n- i", "x"), ("c", "a", "## H\n- i", "x"), ("c", "n", None, None), ("z", "e", "", None), ("z", "l", "word " * 200_000, None)], schema)
    got = {(r.id, r.block_kind, r.block_text) for r in markup_blocks.blocks(df).collect()}
    assert got == {("a", "heading", "H"), ("a", "list_item", "i")}
    assert {r.id: r.clean_text for r in markup_blocks.clean(df).where("id = 'n'").collect()} == {"n": None}
    assert markup_blocks.blocks(df.limit(0)).count() == 0
