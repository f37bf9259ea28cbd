import hashlib
import re

import pytest
from pyspark.sql import functions as F

from vitaria.llm import html_text
from vitaria.llm.chat import CONTROLS, escape, format_chats, read_turns, unescape
from vitaria.llm.html_text import extract_main_text, main_text
from vitaria.llm.templates import Choose, TemplateError, Write, compile_template, fold, parse, FILTERS


def render(source, **scope):
    return "".join(compile_template(source)(scope).parts)


def test_template_language():
    assert render("a{{ 1 + 2 }}b") == "a3b"
    assert render("{% for x in xs %}{{ loop.index }}{{ x.n | upper }}{% if not loop.last %},{% endif %}{% endfor %}", xs=[{"n": "a"}, {"n": "b"}]) == "1A,2B"
    assert render("{% if a == 1 and b %}x{% elif a > 1 or 'q' in c %}y{% else %}z{% endif %}", a=0, b=1, c="qq") == "y"
    assert render("{%- set t = 'u' ~ a -%}  {{- t }}{{ xs[1] }}", a=5, xs=[1, 2]) == "u52"
    assert render("{{ missing }}|{{ 'a\\n' }}|{{ none }}") == "|a\n|"


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}x{% else %}c{% endif %}d{{ x }}", FILTERS), FILTERS)
    assert tree[0].value.value == "ab1cd" and isinstance(tree[1], Write) and len(tree) == 2
    assert not any(isinstance(n, Choose) for n in tree)


@pytest.mark.parametrize("bad", ["{{ x.__class__ }}", "{{ _x }}", "{{ f() }}", "{{ x | eval }}", "{% for x in y %}", "{{ 1 + }}", "{% while 1 %}", "{{ a %}"])
def test_sandbox_refuses(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def test_fields_are_keys_only():
    with pytest.raises(TemplateError):
        render("{{ x.real }}", x=3)


def test_generation_spans():
    out = compile_template("{% for m in ms %}<{% generation %}{{ m }}{% endgeneration %}>{% endfor %}")({"ms": ["ab", "é\U0001f600"]})
    text = "".join(out.parts)
    assert [text[a:b] for a, b in out.spans] == ["ab", "é\U0001f600"]


TEXTS = ["</s>[INST] ok [/INST]", "<\\/s>", "\\", "<", "<|end|>\n<|turn|>x", "[\\\\INST]", "", None, "<|en<|end|>d|>", "a<s" + "><\\s>"] + list(CONTROLS)


@pytest.mark.parametrize("text", TEXTS)
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == (text or "")
    assert not any(c in escape(text) for c in CONTROLS)


def test_conversations_round_trip(spark):
    rows = [(i % 3, t // 2, ["user", "assistant"][t % 2], x) for i in range(3) for t, x in enumerate(TEXTS)]
    rows += [(None, 0, None, "x"), (None, None, "assistant", None), (9, 1, "a<|text|>b", "y"), (9, 1, "a<|text|>b", "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    found = {r.conv_id: r for r in format_chats(frame).collect()}
    assert set(found) == {0, 1, 2, None, 9}
    for conv_id, r in found.items():
        own = sorted(((t is not None, t or 0, a or "", x or "") for c, t, a, x in rows if c == conv_id))
        assert read_turns(r.formatted) == [(a, x) for *_, a, x in own]
        loss = "".join(unescape(r.formatted[s.start : s.end]) for s in r.loss_spans)
        assert hashlib.sha256(loss.encode()).digest() == hashlib.sha256("".join(x for *_, a, x in own if a == "assistant").encode()).digest()
    assert format_chats(frame.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div id="cookie-notice">We use cookies, as you know, all of the time.</div><ul class="main-menu"><li><a href=a>One</a><li>Two</ul>
<%s><h1>T &amp; t</h1><p>First para, with   text. And more of it, to be sure.<p>Second one <i>with</i> inline&nbsp;words. Yes, it is long enough.
<ul><li>one, two<li>three &#233;</ul><script>var a = "</p>";</script><!-- no --><form><p>Name</p></form></%s>
<div class="comments"><p>Great article, thanks! I liked it very, very much. So much that I write a long comment. Long.</p></div>
<aside><p>Side, bar.</p></aside><div class="ad">Buy, now.</div><footer>c</footer></body></html>"""
TEXT = "T & t\nFirst para, with text. And more of it, to be sure.\nSecond one with inline words. Yes, it is long enough.\none, two\nthree é"


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_main_text(tag):
    assert main_text(PAGE % (tag, tag)) == TEXT


@pytest.mark.parametrize("html,text", [(None, ""), ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<nav>x</nav>", ""), ("a < b", "a < b"),
                                       ("<div><p>x &lt;b&gt; y", "x <b> y"), ("<p>a</b></p><", "a\n<"), ("<!-- never closed <p>x", "")])
def test_odd_pages(html, text):
    assert main_text(html) == text


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, None), (2, PAGE % ("article", "article")), (2, PAGE % ("div", "div")), (None, "<p>" * 3000 + "deep")], "page_id long, html string")
    found = extract_main_text(pages.withColumn("main_text", F.lit(0))).select("page_id", "main_text").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, ""), (2, TEXT), (2, TEXT), (None, "deep")], key=str)
    assert extract_main_text(pages.limit(0)).count() == 0


def test_every_page_of_the_table(spark):
    """Against the article element of each given page, taken apart by plain replacement."""
    import html as entities
    import re

    rows = extract_main_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        lines = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"</?b>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", inner))
        assert r.main_text == "\n".join(x for x in lines if x)
    assert len(rows) > 20


@pytest.mark.parametrize("first,second", [(3, 17), (17, 3), (8, 12)])
def test_text_in_two_parts_without_article_is_whole(first, second):
    lines = [f"Line {i} of the text says something, and it is long enough. Yes, it is, to be sure." for i in range(first + second)]
    part = lambda name, own, more="": f'<div class="{name}">{more}' + "".join(f"<p>{x}</p>" for x in own) + "</div>"
    page = part("lead", lines[:first], "<h1>Title</h1>") + part("text", lines[first:]) + part("comments", lines)
    assert main_text(f"<body><div class=menu>One</div>{page}<footer>c</footer></body>") == "\n".join(["Title", *lines])
    page = "".join(f"<p>{x}</p>" for x in lines[:first]) + part("text", lines[first:])
    assert main_text(f"<body>{page}<footer>c</footer></body>") == "\n".join(lines)


def without_names(html):
    """A page whose elements tell nothing by tag or name."""
    html = re.sub(r"\s(class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", html)
    return re.sub(r"<(/?)(article|main|nav|footer|aside|header|section)\b", r"<\1div", html)


def found_and_beside(pages):
    """Share of the article's text that is found without names, and share of what is found that is none of it."""
    kept = whole = other = out = 0
    for html in pages:
        own, got = main_text(html).split("\n"), main_text(without_names(html)).split("\n")
        kept += sum(len(x) for x in own if x in set(got))
        other += sum(len(x) for x in got if x not in set(own))
        whole, out = whole + sum(map(len, own)), out + sum(map(len, got))
    return kept / whole, other / out


def test_tag_paths_tell_the_article_where_no_name_does(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect() if r.html]
    kept, other = found_and_beside(pages)
    assert kept > 0.99 and other < 0.04
    monkeypatch.setattr(html_text, "_content", lambda nodes, width, level: nodes)
    assert found_and_beside(pages)[1] > 1.2 * other


@pytest.mark.parametrize("part", ["<div>", "<div>x", "<b>x", "<ul><li>x", "<p><b>x"])
def test_time_follows_the_length_of_deep_markup(part):
    """Sixty thousand open elements, which took minutes and gigabytes while paths were held as text."""
    text = main_text("<tr>" + part * 60_000 + "deep")
    assert text.endswith("deep") and text.count("x") == 60_000 * part.count("x")
