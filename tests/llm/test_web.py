"""HTML rendering and URL templates."""

import random
import re

import pytest

from tagweave.llm import html_text, url_templates

CASES = [
    (None, ""), ("", ""), ("  plain \n text ", "plain text"), ("a<br>b", "a\nb"), ("<p>a<p>b", "a\n\nb"),
    ("<div>a</div><div>b<div>c</div></div>", "a\nb\nc"), ("<b>x</b> <i>y</i>z", "x yz"), ("&amp;lt; &eacute;&#x41;", "&lt; éA"),
    ("<ul><li>a<li>b<ol><li>c<li>d</ol></ul>e", "- a\n- b\n  1. c\n  2. d\n\ne"), ("<ol start=9><li>x<li>y</ol>", "9. x\n10. y"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
    ("<table><tr><th colspan=2>wide title<tr><td>a<td>b</table>", "wide title\na  b"),
    ("<table><tr><td>x<table><tr><td>in<td>ner</table><td>y</table>", "x        y\n\nin  ner"),
    ("<head><title>t</title></head><body>b<script>if (a<b) '</p>'</script><style>p{}</style></body>", "b"),
    ("<style>.ad, p#k{display:none} i{visibility:hidden}</style><p class='x ad'>n</p><p id=k>n</p><i>n</i><p>y", "y"),
    ("<div hidden>n</div><div style='DISPLAY : none'>n</div><template>n</template>y", "y"),
    ("<details><summary>s</summary>n</details><details open><summary>s</summary>y</details>", "s\ns\ny"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"), ("x<!-- n --><img alt='pic'>y", "xpicy"), ("a</p>b", "a\n\nb"), ("<p>a<table><tr><td>b</table>", "a\n\nb"),
    ("<dl><dt>k<dd>v<dt>l</dl>", "k\n    v\nl"), ("unclosed <b", "unclosed"), ("<nav><a href=x>one</a><a>two</a></nav>t", "onetwo\nt"),
]


CASES += [
    ("<style>@media print{.a{display:none}} @media screen{.b{display:none}}</style><p class=a>y<p class=b>n", "y"),
    ("<style>@media (max-width:600px){.a{display:none}} @media (min-width: 50em){.b{display:none}}</style><p class=a>y<p class=b>n", "y"),
    ("<style>@media not screen{.a{display:none}} @media not print{.b{display:none}} @import 'x'; @font-face{src:x}</style><p class=a>y<p class=b>n", "y"),
    ("<style>.a{display:none} .a{display:block}</style><p class=a>y", "y"), ("<style>.a{display:block} .a{display:none}</style><p class=a>n", ""),
    ("<style>#k{display:none} .a{display:block} p{display:block}</style><p class=a id=k>n", ""),
    ("<style>.a{display:none}</style><p class=a style='display:block'>y", "y"),
    ("<style>.a{display:none!important}</style><p class=a style='display:block'>n", ""),
    ("<style>.a{display:none !important}</style><p class=a style='display:block !important'>y", "y"),
    ("<div style='visibility:hidden'>n<b style='visibility:visible'>y</b>n</div>z", "y\nz"),
    ("<style>div .a{display:none} div > .b{display:none} section>p{display:none}</style><div><p class=a>n<div><i class=b>n</i></div></div><p class=a>y", "y"),
    ("<style>/* p{display:none} */ a:hover, .x ~ p{display:none} *{color:red}</style><p>y", "y"),
    ("<div hidden class=a>y</div><style>.a{display:block}</style>", "y"), ("<dialog>n</dialog><dialog open>y</dialog>", "y"),
    ("x <textarea>two\n  lines</textarea>", "x two\n  lines"), ("a <input value=v> <input type=hidden value=n> <input type=submit value=Go>", "a v Go"),
    ("<svg><title>n</title><defs><text>n</text></defs>n<g><text>one <tspan>two</tspan></text></g><text>three</text></svg>", "one two\nthree"),
    ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"), ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>n</annotation></math>", "x=2"),
    ("<table><tr><td rowspan=2>A<td>b<td>c<tr><td>d<td>e</table>", "A  b  c\n   d  e"),
    ("<table><tr><td>a<td rowspan=0>long<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  long  c\nd        e\nf        g"),
    ("<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>1<td>2<td>3</table>", "ab    c\n      d\n1  2  3"),
    ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"), ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
    ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"), ("<ol type=I start=4><li>x<li>y</ol>", "IV. x\nV. y"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_visible_text(html, text):
    assert html_text.visible_text(html) == text


def test_deep_and_random_pages_do_not_fail():
    assert html_text.visible_text("<div>" * 30_000 + "x") == "x"
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<li>", "<ul>", "</ul>", "<table>", "</table>", "<td>", "<tr>", "</td>", "w ", "<b>", "</b>", "<pre>", "</pre>", "<br>",
             "<dd>", "</div>", "<div>", "&amp;", "< ", "<tbody>", "</tr>", "<caption>", "<body>", "<html>", "<head>", "<details>", "</details>", "\0"]
    for _ in range(800):
        page = "".join(rng.choices(parts, k=30))
        text = html_text.visible_text(page)
        if "<details>" not in page:
            assert text.count("w") == page.count("w "), page


def test_words_of_visible_nodes_appear_and_no_others():
    """Random pages: which words show follows from a plain walk with the cascade spelled out."""
    rng = random.Random(9)
    values = [("display", v) for v in ("none", "block", "inline")] + [("visibility", v) for v in ("hidden", "visible", "collapse", "inherit")]
    for _ in range(300):
        rules = []
        for order in range(rng.randrange(7)):
            tag, cls, ident = rng.choice(["", "div", "b"]), rng.choice(["", "p", "q"]), rng.choice(["", "", "k"])
            parent = rng.choice(["", "", "div ", "i > ", ".q "])
            if not (tag or cls or ident):
                continue
            name, value = rng.choice(values)
            rules.append((rng.random() < 0.15, (bool(ident), bool(cls) + parent.startswith("."), bool(tag) + bool(parent.strip(" >")) * (not parent.startswith("."))),
                          order, parent, tag, cls, ident, name, value))
        css = "".join(f"{par}{t}{'.' + c if c else ''}{'#' + i if i else ''} {{ {n}: {v}{' !important' if imp else ''} }}\n" for imp, _, _, par, t, c, i, n, v in rules)
        words, html = [], []

        def node(depth, path, box, visible):
            tag, cls, ident = rng.choice(["div", "b", "i"]), rng.choice(["", "p", "q", "p q"]), rng.choice(["", "", "k"])
            inline = [(*rng.choice(values), rng.random() < 0.2) for _ in range(rng.choice([0, 0, 1, 2]))]
            won = {}
            for imp, weight, order, parent, t, c, i, name, value in rules:
                if t in ("", tag) and (not c or c in cls.split()) and (not i or i == ident):
                    inside = {"": True, "div ": any(p[0] == "div" for p in path), ".q ": any("q" in p[1] for p in path), "i > ": bool(path) and path[-1][0] == "i"}
                    if inside[parent]:
                        won.setdefault(name, []).append(((imp, 0, weight, order), value))
            for order, (name, value, imp) in enumerate(inline):
                won.setdefault(name, []).append(((imp, 1, (0, 0, 0), order), value))
            style = {name: max(found)[1] for name, found in won.items()}
            box = box and style.get("display") != "none"
            visible = {"hidden": False, "collapse": False, "visible": True}.get(style.get("visibility"), visible)
            text = ";".join(f"{n}:{v}{'!important' if imp else ''}" for n, v, imp in inline)
            html.append(f"<{tag} class='{cls}'" + (f" id={ident}" if ident else "") + (f" style='{text}'" if text else "") + ">")
            for _ in range(rng.randrange(1, 4)):
                word = f"w{len(html)}x"
                html.append(f" {word} ")
                words.append((word, box and visible))
                if depth < 4 and rng.random() < 0.6:
                    node(depth + 1, [*path, (tag, cls.split())], box, visible)
            html.append(f"</{tag}>")

        node(0, [], True, True)
        page = f"<style>{css}</style>" + "".join(html)
        assert html_text.visible_text(page).split() == [w for w, ok in words if ok], page


def test_extract_keeps_every_row(spark):
    d = spark.createDataFrame([(1, "<p>a<p>b", 5), (1, None, 6), (None, "x", 7)], "page_id long, html string, n_lines int")
    got = sorted(((r.page_id or 0), r.text, r.n_lines) for r in html_text.extract_text(d).collect())
    assert got == [(0, "x", 1), (1, "", 0), (1, "a\n\nb", 3)]


def parse(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [r for r in url_templates.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    r = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (r[1] + r[2], r[0]) if r else (None, None)


def test_hosts_paths_and_rules(spark):
    rng = random.Random(2)
    urls = [None, "", "no scheme", "://", "x://", "http://COM/", "http://a.com", "http://notcom/", "http://example.com/en/", "http://www.EXAMPLE.com/en/x",
            "http://x.www.example.com/en/x?y", "https://net/es/", "https://a.net/es", "http://É.net/fr/#/", "a://b://c/d", "http://h?q/x", "http://h#/en/", "http://u:1/\nx/y"]
    urls += [f"http://{rng.choice(['a.net', 'b.org', 'shop.example.com'])}/{rng.choice(['en', 'es', 'item'])}/{rng.randrange(50)}{rng.choice(['', '.html', '/', '?a=1'])}"
             for _ in range(300)]
    rows = url_templates.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = parse(urls[r.page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (verdict or ("block" if r.blocked_share >= 0.5 else "allow"))


def test_templates_generalise_and_reject(spark):
    urls = [f"http://s.net/es/spam/{w}/page{i}" for i in range(3) for w in "abcdefghijklmnopqrst"] + [f"http://s.net/es/{i}" for i in range(40)]
    urls += [f"http://s.net/more/{i}" for i in range(2)] + [f"http://t.org/{w}{i}xyzq/{i}" for i in range(30) for w in "uv"]
    rows = url_templates.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    by_url = {urls[r.page_id]: r for r in rows}
    assert by_url["http://s.net/es/spam/a/page1"].template.startswith("/es/spam/*/")
    assert by_url["http://s.net/more/1"].verdict == "block"  # hardly seen, on a host that is blocked nearly everywhere
    assert by_url["http://t.org/u3xyzq/3"].verdict == "allow" and by_url["http://t.org/u3xyzq/3"].template == "/{id}/{n}"
