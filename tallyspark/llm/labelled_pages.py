"""Labelled pages for the extraction model.

Every page is written out as mark-up with ``data-content`` set to "1" on the elements that hold
the article and to "0" where boilerplate begins again inside it; an element without the mark has
its parent's label.  ``{p}`` stands for a paragraph, ``{s}`` for a sentence, ``{w}`` for a few words:
filler by rule, so that lengths and sentence marks vary as on real pages.  ``{c}`` marks an element as
content, ``{n}`` as boilerplate.
"""

from __future__ import annotations

from itertools import count

WORDS = ("river stone market evening letter garden window signal harbour engine paper winter "
         "village number teacher music planet copper forest answer bridge summer").split()


def words(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] for i in range(n))


def sentence(seed: int) -> str:
    return words(seed, 4 + seed % 9).capitalize() + "."


def paragraph(seed: int) -> str:
    return " ".join(sentence(seed + i) for i in range(1 + seed * seed % 7))


def filled(template: str) -> str:
    seeds = count(1)
    template = template.replace("{c}", ' data-content="1"').replace("{n}", ' data-content="0"')
    for mark, make in (("{p}", paragraph), ("{s}", sentence), ("{w}", lambda s: words(s, 1 + s % 3).title())):
        head, *rest = template.split(mark)
        template = head + "".join(make(next(seeds)) + part for part in rest)
    return template


HEAD = '<!DOCTYPE html><html><head><meta charset="utf-8"><title>{w}</title><style>p{}</style></head><body>'
LINKS = "".join('<li><a href="/">{w}</a></li>' for _ in range(6))
NAV = f"<nav><ul>{LINKS}</ul></nav>"
FOOT = "<footer>&copy; {w} &middot; {s}</footer></body></html>"

TEMPLATES = [
    # plain article with a menu, an advert and a footer; paragraphs and bold left open
    HEAD + NAV + '<div class="ad">{s}</div><article data-content="1"><h1>{w}</h1><p><b>{s}<br><p>{p}</p>'
    "<p>{p}</p><p>{w}.</p><p>{p}</p><p><b>{s}<br><p>{p}</p></article>" + FOOT,
    HEAD + NAV + '<div class="ad">{s}</div><article data-content="1"><h1>{s}</h1><p>{p}</p></article>' + FOOT,
    HEAD + NAV + '<div class="ad">{s} {s}</div><article data-content="1"><h1>{w}</h1><p><b>{p}<br><p>{p}</p>'
    "<p>{p}</p><p>{p}</p><p>{p}</p></article>" + FOOT,
    # header, main, sidebar, comments
    HEAD + '<header class="site-header"><a class="logo" href="/">{w}</a><p class="tagline">{s}</p>' + NAV
    + '</header><main data-content="1"><article><h1>{w}</h1><p>{p}</p><h2>{w}</h2><p>{p}</p><ul><li>{s}</li>'
    "<li>{s}</li></ul><blockquote><p>{p}</p></blockquote><p>{p}</p><figure><img src=x><figcaption>{s}</figcaption>"
    '</figure></article><section class="comments" id="comments" data-content="0"><h2>{w}</h2>'
    '<div class="comment"><p>{p}</p></div><div class="comment"><p>{s}</p></div><form class="comment-form">'
    "<label>{w}</label><p>{s}</p></form></section></main>"
    '<aside class="sidebar"><h3>{w}</h3><ul>' + LINKS + "</ul><p>{s}</p></aside>" + FOOT,
    # containers named by class
    HEAD + '<div id="header"><div class="menu"><a href="/">{w}</a> <a href="/">{w}</a></div></div>'
    '<div class="cookie-notice banner"><p>{s} {s}</p></div><div id="wrapper" class="container">'
    '<div class="post" data-content="1"><h2 class="post-title">{w}</h2><div class="entry-content"><p>{p}</p><p>{p}</p>'
    '<p>{p}</p><div class="share social" data-content="0"><a href="/">{w}</a><a href="/">{w}</a></div><p>{s}</p></div></div>'
    '<div id="sidebar" class="widget"><h3>{w}</h3><p>{s}</p></div></div><div id="footer" class="footer"><p>{s}</p></div>',
    # notices, adverts and related links inside the text column
    HEAD + '<div class="notice alert" role="alert"><p>{s}</p></div><div id="content" class="main" data-content="1"><h1>{w}</h1>'
    '<p>{p}</p><div class="advert advertisement sponsored" data-content="0"><p>{s}</p></div><p>{p}</p><p>{p}</p>'
    '<div class="related" data-content="0"><h3>{w}</h3><ul>' + LINKS + "</ul></div><p>{p}</p></div>"
    '<div class="newsletter subscribe signup"><form><p>{s}</p></form></div><div class="copyright legal"><p>{s}</p></div>',
    # search and login forms, breadcrumb, pagination
    HEAD + '<div class="top bar"><form class="search" role="search"><p>{w}</p></form><form class="login"><p>{s}</p></form></div>'
    '<ol class="breadcrumb" role="navigation"><li><a href="/">{w}</a></li><li>{w}</li></ol>'
    '<section class="article body" itemprop="articleBody" data-content="1"><h1>{w}</h1><p>{s}</p><p>{p}</p><pre>{s}</pre>'
    "<table><tr><th>{w}</th><td>{w}</td></tr><tr><td>{w}</td><td>{s}</td></tr></table><p>{p}</p></section>"
    '<div class="pagination pager"><a href="/">{w}</a> <a href="/">{w}</a></div>' + FOOT,
    # reader comments outside, promotions, popups
    HEAD + '<div class="popup modal overlay"><p>{s}</p></div><article class="story" data-content="1"><header><h1>{w}</h1></header>'
    "<p>{p}</p><p>{p}</p><h3>{w}</h3><p>{p}</p><p>{s}</p></article>"
    '<div class="replies responses discussion"><ul><li><p>{s}</p></li><li><p>{p}</p></li></ul></div>'
    '<div class="promo sponsor banner ads"><p>{s}</p></div><div class="tags meta"><a href="/">{w}</a></div>' + FOOT,
    # the text lies in the body itself between boilerplate
    HEAD + '<div class="navbar navigation">' + LINKS.replace("li>", "span>") + '</div><div data-content="1" class="text"><p>{p}</p>'
    '<p>{p}</p><p>{p}</p></div><div class="gdpr consent cookies"><p>{s}</p></div><address class="contact">{w}</address>' + FOOT,
    # a menu page: no article at all
    HEAD + "<header><h1>{w}</h1></header>" + NAV + '<div class="links list"><ul>' + LINKS + LINKS + "</ul></div>"
    '<aside><p>{s}</p></aside><div class="ad"><p>{s}</p></div>' + FOOT,
    # notices and forms beside a main element
    HEAD + '<header><p>{s}</p></header><nav><a href="/">{w}</a><a href="/">{w}</a></nav><main data-content="1"><h1>{w}</h1><p>{p}</p>'
    "<p>{p}</p><ol><li>{s}</li><li>{s}</li></ol><dl><dt>{w}</dt><dd>{s}</dd></dl><p>{s}</p></main><aside class=\"notice warning\"><p>{s}</p>"
    '</aside><form action="/"><fieldset><legend>{w}</legend><p>{s}</p></fieldset></form>' + FOOT,
    # article with byline, share bar and comments of its own
    HEAD + NAV + '<article data-content="1"><h1>{w}</h1><p>{p}</p><p>{p}</p><aside data-content="0"><p>{s}</p></aside><p>{p}</p>'
    '<div class="ad" data-content="0">{s}</div><p>{p}</p><nav data-content="0"><a href="/">{w}</a></nav>'
    '<div class="comments" data-content="0"><p>{s}</p><p>{p}</p></div><form data-content="0"><p>{s}</p></form>'
    '<footer data-content="0"><p>{s}</p></footer></article>' + FOOT,
]

# Names that sites give to what is not the article, and to what is (fixed values); each gets pages
# on which it stands beside the article and inside it, with and without elements around them.
ASIDE = ("comments comment reply respond disqus sidebar widget footer header nav menu ad ads advert banner "
         "sponsor promo cookie consent notice alert popup modal newsletter subscribe share social related "
         "recommended breadcrumb pagination search login signup tags meta author copyright toolbar").split()
MAIN = "article post story entry content main body text".split()

BESIDE = (HEAD + NAV + '<div class="{main}" data-content="1"><h1>{{w}}</h1><p>{{p}}</p><p>{{p}}</p><p>{{s}}</p></div>'
          '<{tag} class="{name}" id="{name}"><h3>{{w}}</h3><p>{{p}}</p><ul><li>{{s}}</li></ul></{tag}>' + FOOT)
INSIDE = (HEAD + '<header><h1>{{w}}</h1></header><article data-content="1"><h1>{{w}}</h1><p>{{p}}</p><p>{{p}}</p>'
          '<{tag} class="{name}" data-content="0"><p>{{p}}</p><div class="{name}-item"><p>{{s}}</p></div></{tag}>'
          "<p>{{p}}</p></article>" + FOOT)

NESTED = ('<html><body><div><div><div class="{main}" data-content="1"><h1>{{w}}</h1><div><p>{{p}}</p><p>{{p}}</p></div></div></div>'
          '<{tag} id="{name}"><div><div><p>{{p}}</p><p>{{p}}</p></div><div><p>{{s}}</p></div></div></{tag}></div></body></html>')
BARE = ('<div class="{name}"><p>{{p}}</p></div><article data-content="1"><h1>{{w}}</h1><p>{{p}}</p><div><p>{{p}}</p></div><p>{{s}}</p>'
        '<{tag} class="{name}" data-content="0"><div><p>{{p}}</p></div><div><p>{{s}}</p></div></{tag}></article>')


def named(template: str, i: int, name: str) -> str:
    made = template.replace("{{", "\0").replace("}}", "\1")
    for key, value in (("{main}", MAIN[i % len(MAIN)]), ("{name}", name),
                       ("{tag}", ("div", "section", "aside")[i % 3])):
        made = made.replace(key, value)
    return made.replace("\0", "{").replace("\1", "}")


# Pages without an element for the article: its blocks lie in the body, in unnamed containers, in table
# cells, or the text lies in the body itself.
TEXT = "<p{c}>{p}</p><p{c}>{p}</p>"
LOOSE = "{s} {p}<br><br>{p}<br>{s}"
BAR = '<div><a href="/">{w}</a> | <a href="/">{w}</a> | <a href="/">{w}</a></div>'
PLAIN = [
    "<html><body><h1{c}>{w}</h1>" + TEXT + "</body></html>",
    "<html><body><h1{c}>{w}</h1><h2{c}>{s}</h2>" + TEXT + "<ul{c}><li>{s}</li><li>{w}</li></ul><p{c}>{s}</p></body></html>",
    HEAD + NAV + "<h1{c}>{w}</h1>" + TEXT + "<p{c}>{s}</p>" + FOOT,
    HEAD + "<header><h2>{w}</h2>" + NAV + "</header><h1{c}>{s}</h1>" + TEXT + '<div class="ad">{s}</div>' + TEXT + FOOT,
    HEAD + '<div id="menu"><ul>' + LINKS + "</ul></div><h2{c}>{w}</h2>" + TEXT + "<blockquote{c}>{p}</blockquote>"
    '<div class="sidebar"><p>{s}</p></div><p{c}>{p}</p><address>{w}</address></body></html>',
    TEXT, "<h1{c}>{w}</h1>" + TEXT, "<p{c}>{s}</p>", "<h3{c}>{w}</h3><p{c}>{p}</p><pre{c}>{s}</pre><p{c}>{s}</p>",
    TEXT + NAV + FOOT,
    "<html><body{c}>" + LOOSE + "</body></html>", "<html><body{c}><b>{w}</b><br>" + LOOSE + "<hr>{p}</body></html>",
    "<html><body{c}><h1>{w}</h1>" + LOOSE + "<p>{p}</p></body></html>",
    "<html><head><title>{w}</title></head><body{c}><nav{n}><ul>" + LINKS + "</ul></nav>" + LOOSE + "<footer{n}>{s}</footer></body></html>",
    "<html><body{c}><center><h2>{w}</h2></center>" + LOOSE + "<blockquote>{p}</blockquote>{p}<hr><address{n}>{w}</address></body></html>",
    "<html><body{c}>" + BAR.replace("<div>", "<div{n}>") + "<h1>{w}</h1>" + LOOSE + "<div class=\"ad\"{n}>{s}</div>{p}</body></html>",
    "<html><body{c}><center{n}><a href=\"/\">{w}</a> <a href=\"/\">{w}</a></center><h3>{w}</h3>{p}<p>{p}<p>{p}<p>{s}"
    "<div class=\"footer\"{n}>{s}</div></body></html>",
    "<body><section{c}><h1>{w}</h1><p>{p}</p><p>{p}</p></section></body>",
    HEAD + NAV + "<section{c}><h2>{w}</h2><p>{p}</p></section><section{c}><h2>{w}</h2><p>{p}</p><p>{s}</p></section>" + FOOT,
    "<body><div{c}><h1>{w}</h1><p>{p}</p><p>{p}</p></div></body>",
    HEAD + BAR + "<div><div{c}><p>{p}</p><p>{p}</p><p>{s}</p></div></div>" + FOOT,
    "<body><div><div><div{c}><h2>{w}</h2><p>{p}</p><div><p>{p}</p><p>{s}</p></div></div></div></div></body>",
    "<body>" + BAR + "<div{c}>{p}</div><div{c}>{p}</div><div{c}>{s}</div><div>{w} <a href=\"/\">{w}</a></div></body>",
    "<html><body><table><tr><td><a href=\"/\">{w}</a><br><a href=\"/\">{w}</a><br><a href=\"/\">{w}</a></td>"
    "<td{c}><h1>{w}</h1><p>{p}</p><p>{p}</p></td></tr></table></body></html>",
    "<html><body><table><tr><td>" + BAR + "</td></tr><tr><td{c}>{p}<br><br>{p}</td></tr><tr><td>{w} <a href=\"/\">{w}</a></td></tr>"
    "</table></body></html>",
    "<html><body><center>" + BAR + "</center><table><tr><td width=1><ul>" + LINKS + "</ul></td><td{c}><p>{p}<p>{p}<p>{s}</td></tr></table>"
    "<center><small>&copy; {w}</small></center></body></html>",
    "<body><h1{c}>{w}</h1><p{c}>{p}</p><table{c}><tr><th>{w}</th><th>{w}</th></tr><tr><td>{w}</td><td>{s}</td></tr></table><p{c}>{p}</p></body>",
    "<body><dl{c}><dt>{w}</dt><dd>{s}</dd><dt>{w}</dt><dd>{p}</dd></dl><p{c}>{p}</p></body>",
    "<body><form action=\"/\"><p>{w}</p></form><h1{c}>{w}</h1>" + TEXT + '<div class="comments"><p>{p}</p><p>{s}</p></div></body>',
    "<body><main{c}><section><h1>{w}</h1><p>{p}</p><p>{p}</p></section><section><p>{p}</p><p>{s}</p></section></main><footer>{s}</footer></body>",
    HEAD + "<header>{w}</header><main{c}><div><h2>{w}</h2><p>{p}</p></div><section><h3>{s}</h3><p>{p}</p></section></main>" + FOOT,
    "<body><article{c}><section><h2>{w}</h2><p>{p}</p></section><section><h2>{w}</h2><p>{p}</p><p>{p}</p></section></article></body>",
    HEAD + "<header><p>{w}</p></header><section{c}><h1>{w}</h1><p>{p}</p></section>" + FOOT,
    "<body><section{c}><h2>{w}</h2><p>{p}</p></section><section{c}><p>{p}</p><p>{p}</p></section><aside><p>{s}</p></aside></body>",
    "<html><body><center{c}><h1>{w}</h1></center>" + TEXT + "<p{c}>{s}</p></body></html>",
    "<html><body><center{c}><b>{s}</b></center><hr>" + TEXT + TEXT + "<center>" + BAR + "</center></body></html>",
    "<body><p{c}>{p}</p><ul{c}><li>{s}</li><li>{s}</li></ul><form><p>{w}</p></form></body>",
    "<body><h1{c}>{w}</h1><p{c}>{p}</p><ol{c}><li>{p}</li><li>{s}</li><li>{s}</li></ol><p{c}>{p}</p></body>",
    HEAD + NAV + "<p{c}>{p}</p><ol{c}><li>{s}</li><li>{s}</li><li>{s}</li></ol><ul{c}><li>{w}</li><li>{s}</li></ul><p{c}>{p}</p>" + FOOT,
    "<body><ul{c}><li><p>{p}</p></li><li><p>{s}</p></li></ul><p{c}>{p}</p><ul><li><a href=\"/\">{w}</a></li></ul></body>",
    "<body><p{c}>{p}</p><aside><p>{s}</p></aside><p{c}>{p}</p><nav><a href=\"/\">{w}</a></nav></body>",
]

PAGES = [filled(t) for t in TEMPLATES + PLAIN + PLAIN + [named(t, i, name) for i, name in enumerate(ASIDE)
                                         for t in (BESIDE, INSIDE, NESTED, BARE)]]
