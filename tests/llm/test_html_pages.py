"""Operator 10 on pages built from known articles, and on names that say one
thing while the part holds another."""

import random

import pytest

from tidemark.llm.html_text import main_text

WORDS = "the river, stone and morning house of a quiet, long street was there when people came, so it went on".split(" ")
P = "A long paragraph of the article, with commas, and words that go on for quite a while so that it counts."


def para(rng, least=18):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(least, 60))) + "."


def p3(n=3):
    return f"<p>{P}</p>" * n


@pytest.mark.parametrize("page, want", [
    (f'<div class="post no-comments">{p3()}</div>', [P] * 3),
    (f'<div data-hidden="false">{p3()}</div>', [P] * 3),
    (f'<div title="hidden gem" data-role="comment">{p3()}</div>', [P] * 3),
    (f'<section id="social-policy">{p3(4)}</section><div><p>Tiny neighbour, here.</p></div>', [P] * 4),
    (f"<section>{p3(4)}</section><section><p>Second part, shorter one.</p></section>", [P] * 4 + ["Second part, shorter one."]),
    (f"<div>{p3(4)}</div><p>The end.</p>", [P] * 4 + ["The end."]),
    (f"<article>{p3(2)}<figure><img src=x><figcaption>A caption.</figcaption></figure>{p3(1)}</article>", [P, P, "A caption.", P]),
    (f"<article>{p3(2)}<table><tr><td><a href=x>Link one</a></td><td>plain</td></tr></table>{p3(1)}</article>",
     [P, P, "Link one", "plain", P]),
    (f"<article>{p3(2)}<ul><li><a href=x>First source</a></li><li><a href=x>Second</a></li></ul>{p3(1)}</article>",
     [P, P, "First source", "Second", P]),
    (f"<article><ul><li><a href=x>Home</a></li></ul>{p3(2)}<ul><li><a href=x>More</a></li></ul></article>", [P, P]),
    (f'<div class="with-sidebar hide-comments">{p3(2)}<div class="sidebar"><p>{P}</p></div></div>', [P, P]),
    (f'<article>{p3(2)}</article><div class="post-comments">{p3(5)}</div><div id="readerComments">{p3(2)}</div>', [P, P]),
    (f'<div class="content-sidebar"><div class="entry">{p3(3)}</div></div>', [P] * 3),
    (f'<div class="post comments">{p3(3)}</div>', [P] * 3),
    (f'<div hidden>{p3(3)}</div><div style="DISPLAY: none">{p3(3)}</div><p aria-hidden=true>{P}</p><div>{p3(1)}</div>', [P]),
    (f'<div class=ad>{p3(1)}</div><div class="cookie-notice">{p3(1)}</div><div class="site-footer">{p3(1)}</div><div>{p3(2)}</div>', [P] * 2),
])
def test_what_a_part_holds_decides_where_its_name_does_not(page, want):
    assert main_text(f"<html><body>{page}</body></html>") == "\n".join(want)


@pytest.mark.parametrize("seed", range(60))
def test_built_pages(seed):
    """Articles of several blocks in containers of several kinds, among parts
    that are not the article; the text is the article's blocks, in order."""
    rng = random.Random(seed)
    blocks, html = [], []
    for _ in range(rng.randint(3, 12)):
        kind = rng.choice(["p", "p", "p", "h2", "ul", "quote", "pre", "figure", "table", "amp"])
        if kind in ("p", "amp"):
            t = para(rng)
            blocks.append(t if kind == "p" else f"{t} R&D < é")
            body = t if kind == "p" else f"{t} R&amp;D &lt; &eacute;"
            html.append(f"<p class='x{rng.randint(0, 9)}'>{body.replace(' and ', ' <b>and</b> ')}</p>"
                        if rng.random() < 0.7 else f"<p>{body}\n")
            if not html[-1].endswith("</p>"):
                html.append("</p>")
        elif kind == "h2":
            blocks.append("Part of it")
            html.append("<h2>Part\n of  it</h2>")
        elif kind == "ul":
            items = [para(rng, 5) for _ in range(rng.randint(1, 4))]
            blocks += items
            html.append("<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>")
        elif kind == "quote":
            t = para(rng)
            blocks.append(t)
            html.append(f"<blockquote><p>{t}</p></blockquote>")
        elif kind == "pre":
            blocks.append("a = b, c")
            html.append("<pre>a = b,\n   c</pre>")
        elif kind == "figure":
            blocks.append("What it shows, in short.")
            html.append("<figure><img alt='no'><figcaption>What it shows, in short.</figcaption></figure>")
        else:
            blocks += ["one", "two"]
            html.append("<table><tr><td>one<td>two</table>")
    blocks.append(end := para(rng, 40))
    html.append(f"<p>{end}</p>")
    junk = ["<nav><ul><li><a href=/>Home</a></ul></nav>", "<header><p>Site, with a name, and a claim.</p></header>",
            f"<aside><p>{para(rng)}</p></aside>", f"<div class='ad'>{para(rng)}</div>", "<script>var a = '<p>no, no</p>';</script>",
            f"<div id='comments'><p>{para(rng)}</p></div>", "<form><p>Name, please</p><input></form>", f"<!-- {para(rng)} -->",
            f"<section class='related-links'><p>{para(rng)}</p></section>", "<style>p{color:red}</style>",
            f"<div role='complementary'><p>{para(rng)}</p></div>", f"<div class='newsletter signup'>{para(rng)}</div>"]
    rng.shuffle(junk)
    at = rng.randint(0, len(junk))
    open_, close = rng.choice([("<article>", "</article>"), ("<div class='post'>", "</div>"), ("<main><div>", "</div></main>"),
                               ("<div>", "</div>"), ("<div id='content'><section>", "</section></div>")])
    page = f"<!doctype html><html><head><title>T</title></head><body>{''.join(junk[:at])}{open_}{''.join(html)}{close}" \
           f"{''.join(junk[at:])}<footer><p>&copy; all, rights.</p></footer></body></html>"
    assert main_text(page) == "\n".join(blocks)
