"""Names of classes and ids against what an element holds."""

import pytest

from reportkit.llm import wrappers as W


def text_of(page):
    return W._main_text(page, "[]", None, None)


@pytest.mark.parametrize("page,text", [
    ('<html class="no-sidebar"><body class="single has-sidebar"><article><p>a</p></article></body></html>', "a"),
    ('<body id="sidebar"><p>a</p></body>', "a"),
    ('<div class="has-sidebar"><div id="menu"><p>m</p></div><article class="post no-comments"><p>a</p><div class="comments"><article class="comment">c</article></div></article></div>', "a"),
    ('<main class="no-sidebar"><p>a</p></main>', "a"),
    ('<article><h2 id="related-work">r</h2><p id="comments-on-x">c <i id="search-algorithms">s</i></p></article>', "r\nc s"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup><annotation>x=y^2</annotation></math> be</p></article>", "Let x=y2 be"),
    ('<article><p>a</p></article><div class="related"><article><p>other</p></article></div>', "a"),
    ('<div class="comments"><article class="comment"><p>c</p></article></div><article><p>a</p></article>', "a"),
    ('<article><p>Press <span class="alert">stop</span> now and <b class="notice">wait</b>.</p></article>', "Press stop now and wait."),
    ('<article><p>A <em class="search-term">fox</em> <a class="nav-link" href=1>here</a> <code class="language-login">x</code> of many</p></article>', "A fox here x of many"),
    ('<article><section id="search-algorithms"><p>a</p></section><section id="related-work"><p>b</p></section><div class="related-work">c</div></article>', "a\nb\nc"),
    ('<article title="the hidden gem"><p>body</p></article>', "body"),
    ('<article><p hidden>no</p><p>a <span hidden>b</span>c</p><div class=x hidden="">no</div></article>', "a c"),
    ('<article><h1>T</h1><div class="promo"><p>body</p></div></article>', "T\nbody"),
    ('<article><p>a</p><div class="cookie-notice">no</div><div id="comments">no</div><div class="share-buttons">no</div><div class="related-posts">no</div>'
     '<p>b <span class="ad">no</span></p><div class="ad-slot">no</div></article>', "a\nb"),
    ("<nav><article><p>n</p></article></nav><div><p>a</p></div>", "a"),
])
def test_names_do_not_hide_the_article(page, text):
    assert text_of(page) == text
