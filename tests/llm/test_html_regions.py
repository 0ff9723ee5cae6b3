"""Pages whose text stands in several regions."""

from lookback.llm.html_text import main_text

LONG = "A long paragraph number {} of the article itself, with many more words than any list or advert has."
P = [LONG.format(i) for i in range(6)]
AD = "<div class=ad><p>Buy now, a long advert that is no part of any article at all</p></div>"
LIST = "<ul>" + "".join(f"<li><a href=x>t{i}</a></li>" for i in range(8)) + "</ul>"


def test_regions_split_by_adverts_or_lists():
    for tag in ("div", "section"):
        page = f"<body><{tag}><p>{P[0]}</p></{tag}>{AD}<{tag}><p>{P[1]}</p><p>{P[2]}</p></{tag}></body>"
        assert main_text(page) == " ".join(P[:3])
    cells = f"<table><tr><td><p>{P[0]}</p></td></tr><tr><td>{AD}</td></tr><tr><td><p>{P[1]}</p><p>{P[2]}</p></td></tr></table>"
    assert main_text(f"<body><nav>menu</nav>{cells}<footer>f</footer></body>") == " ".join(P[:3])
    listed = f"<body><div><p>{P[0]}</p><p>{P[1]}</p></div>{LIST}<div><p>{P[2]}</p><p>{P[3]}</p></div></body>"
    assert main_text(listed) == " ".join([*P[:2], *(f"t{i}" for i in range(8)), *P[2:4]])


def test_several_articles():
    page = f"<body><div class=menu>m</div><article><p>{P[0]}</p></article>{AD}<article><p>{P[1]}</p><p>{P[2]}</p><article>n</article></article><p>out</p>"
    assert main_text(page) == " ".join([*P[:3], "n"])


def test_words_of_ids_and_classes_inside_the_article():
    for open_tag, close in (("<section id='discussion'>", "</section>"), ("<section id=related-work>", "</section>"),
                            ("<div class='social-history'>", "</div>"), ("<div id='ad-hoc-networks'>", "</div>")):
        assert main_text(f"<article><p>{P[0]}</p>{open_tag}<h2 id='social-history'>Head</h2><p>{P[1]}</p>{close}</article>") == f"{P[0]} Head {P[1]}"
    table = "<div class='search-results-table'><table><tr><td>1.5</td><td>2</td></tr></table></div>"
    assert main_text(f"<main><p>{P[0]}</p>{table}<p>{P[1]}</p></main>") == f"{P[0]} 1.5 2 {P[1]}"
    assert main_text(f"<article><p>{P[0]} <span class=notice>a word</span>, more.</p></article>") == f"{P[0]} a word, more."
    assert main_text(f"<article><h2 id=notice><a href='#notice'>Notice</a></h2><p>{P[0]}</p></article>") == f"Notice {P[0]}"
    # Without an article, an id marks no heading and no section either.
    assert main_text(f"<body><p>{P[0]}</p><section id=discussion><h2 id=comments>Head</h2><p>{P[1]}</p></section></body>") == f"{P[0]} Head {P[1]}"


def test_links_and_fields_inside_the_article_still_go():
    share = "<div class='share'><a href=x>Mail it</a> <a href=y>Post it</a></div>"
    signup = "<div id=newsletter>Get our letter <input type=text></div>"
    assert main_text(f"<article><p>{P[0]}</p>{share}{signup}<p>{P[1]}</p></article>") == f"{P[0]} {P[1]}"
    deep = "<article>" + "<div class=notice>" * 3000 + "deep text" + "</div>" * 3000 + "</article>"
    assert main_text(deep) == "deep text"
