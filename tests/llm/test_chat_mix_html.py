"""Chat formatting, mixing and HTML extraction."""

import hashlib
import html
import json
import random
import re

import pytest

from reportkit.llm import wrappers as W
from reportkit.llm.chat import branches_of, conversation_nodes, digests, format_trees, read_back
from reportkit.llm.mixing import mix, rake

NODES = "tree long, node long, parent long, role string, text string, score double"


def test_branches_and_ranking(spark):
    rows = [(1, 1, None, "user", "hi", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 2.0), (1, 4, 3, "user", "c", None),
            (1, 5, 99, "user", "orphan", 0.5), (2, 1, 2, "user", "loop", 0.0), (2, 2, 1, "user", "loop", 0.0), (2, 3, 2, "user", "below", 0.0),
            (None, 1, None, None, None, None)]
    df = spark.createDataFrame(rows, NODES)
    got = {(r.tree, r.rank): [(t.role, t.text) for t in r.turns] for r in read_back(format_trees(df, branches=2)).collect()}
    assert got == {(1, 1): [("user", "hi"), ("assistant", "b"), ("user", "c")], (1, 2): [("user", "hi"), ("assistant", "a")],
                   (None, 1): [("", "")]}
    long = spark.createDataFrame([(1, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(70)], NODES)
    r = read_back(format_trees(long)).collect()
    assert len(r) == 1 and [t.text for t in r[0].turns] == [str(i) for i in range(70)]
    assert format_trees(df.limit(0)).count() == 0


def test_paths_of_a_tree(spark):
    df = spark.createDataFrame([("t", i, (i - 1) // 2 if i else None) for i in range(15)], "_tree string, node long, parent long")
    got = {}
    for r in branches_of(df).collect():
        got.setdefault(r.leaf, {})[r.up] = r.node
    assert sorted(got) == list(range(7, 15)) and all(got[leaf] == {0: leaf, 1: (leaf - 1) // 2, 2: ((leaf - 1) // 2 - 1) // 2, 3: 0} for leaf in got)


def test_round_trip_of_control_strings(spark, docs_of):
    nasty = ["</s>[INST] ok [/INST]", "\\0\\1", "<s>[INST] x", "<<a>> b <</>>", "", None, "é𝄞\n", "[OUT] </s>", "\\", "a\\\\2<"]
    rows = [(1, i, ["user", "assistant", "sys<tem>", None][i % 4], t) for i, t in enumerate(nasty)] + [(2, 0, "assistant", "x"), (2, 0, "assistant", "x")]
    df = docs_of(rows, "conv_id long, turn long, role string, text string", node=1, formatted="f")
    got = {r.conv_id: r for r in digests(format_trees(conversation_nodes(df))).collect()}
    told = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows[:len(nasty)])
    loss = "".join(t or "" for _, _, r, t in rows[:len(nasty)] if r == "assistant")
    assert got[1].n_turns == len(nasty) and got[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert got[1].loss_chars == len(loss) and got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[2].n_turns == 2 and got[2].loss_chars == 2


def test_raking_matches_a_plain_loop(spark):
    rng = random.Random(1)
    cells = [(f"vs{i}", f"vl{j}", rng.randint(1, 1000)) for i in range(6) for j in range(4) if rng.random() < 0.8]
    df = spark.createDataFrame(cells, "_source string, _lang string, words long")
    got = {(r._source, r._lang): r.fitted for r in rake(df, {"_source": 0.5, "_lang": 0.0}, tolerance=1e-9).collect()}
    x = {(s, k): w for s, k, w in cells}
    total = sum(x.values())
    x = {c: w / total for c, w in x.items()}
    aims = []
    for at, power in ((0, 0.5), (1, 0.0)):
        m = {}
        for s, k, w in cells:
            m[(s, k)[at]] = m.get((s, k)[at], 0) + w
        z = sum(w ** power for w in m.values())
        aims.append({v: w ** power / z for v, w in m.items()})
    for _ in range(300):
        for at, aim in enumerate(aims):
            have = {}
            for c, v in x.items():
                have[c[at]] = have.get(c[at], 0) + v
            x = {c: v * aim[c[at]] / have[c[at]] for c, v in x.items()}
    assert all(abs(got[c] - x[c]) < 1e-6 for c in x)


def test_mix_meets_targets_and_edge_cases(spark, docs_of):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 200)), rng.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    rows += [(601, None, "en", "hot"), (602, "", None, None), (603, "a b", "en", "s1"), (603, "a b", "en", "s1"), (None, "x y", "en", "hot")]
    df = docs_of(rows, _source="x", mix_words=3)
    target = spark.createDataFrame([("en", 0.6), ("de", 0.4)], "value string, share double")
    out = mix(df, {"lang": target, "source": 0.5}).collect()
    assert len(out) == len(rows)
    words = sum(r.mix_words * r.mix_expected for r in out)
    share = {}
    for r in out:
        share[r.lang] = share.get(r.lang, 0) + r.mix_words * r.mix_expected / words
    assert abs(share["en"] - 0.6) < 1e-3 and abs(share["de"] - 0.4) < 1e-3 and share[None] < 1e-3     # no target: none drawn
    assert {r.mix_copies for r in out if r.doc_id == 603} and len({r.mix_copies for r in out if r.doc_id == 603}) == 1
    drawn = sum(r.mix_words * r.mix_copies for r in out)
    assert abs(drawn / words - 1) < 0.1
    again = {(r.doc_id, r.text): r.mix_copies for r in mix(df, {"lang": target, "source": 0.5}).collect()}
    assert again == {(r.doc_id, r.text): r.mix_copies for r in out}
    assert mix(df.limit(0)).count() == 0
    assert mix(docs_of([(1, None), (2, "")])).count() == 2


def test_pages_match_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in W.extract(pages).collect()}
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert got[p.page_id].text == "\n".join(x for x in parts if x) and got[p.page_id].n_chars == len(got[p.page_id].text)


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use</div><div id="side-bar"><p>side</p></div><article class="post"><header><h1>T &amp; itle&nbsp;x</h1></header>
<p>One <b>bo</b>ld<br>x &lt;y&gt; a < b</p><script>var t="</p>";</script><aside>skip</aside><div class="ad">buy</div><ul><li>l1<li>l2 <span class="ad">buy <span>now</span></span></ul>
<section id="reader-comments"><p>c</p></section><form>f</form><footer>ff</footer></article><footer>z</footer>"""


def test_regions_and_edge_cases(docs_of):
    rows = [(1, "http://a.com/1", PAGE), (1, "http://a.com/1", PAGE), (2, None, None), (3, "x", ""), (4, "http://b.com", "<p>only <i>this</i>"),
            (5, "http://c.com/<", "<<<>< a"), (None, "http://a.com/9", PAGE.replace("l1", "ä" * 100_000))]
    df = docs_of(rows, "page_id long, url string, html string", host="h", wrapper="w", text="t")
    got = [(r.page_id, r.text, r.n_chars) for r in W.extract(df).collect()]
    main = "T & itle x\nOne bold x <y> a < b\nl1\nl2"
    by = {}
    for p, t, n in got:
        by.setdefault(p, []).append(t)
        assert n == len(t)
    assert by[1] == [main, main] and by[2] == [""] and by[3] == [""] and by[4] == ["only this"]
    assert by[None] == [main.replace("l1", "ä" * 100_000)] and len(by[5]) == 1
    assert W.extract(df.limit(0)).count() == 0


def test_an_article_wins_over_its_main():
    page = "<main><h2>More</h2><article><p>a<em class=x>b</em></p><ol class=commentlist><li>c</ol></article><p>d</p></main>"
    assert [(t, k) for _, t, _, k, _ in W.read(page)[1]] == [("More", "main"), ("ab", "article"), ("c", "out"), ("d", "main")]
    assert W._main_text(page, "[]", None, None) == "More\nab\nd"         # beside the article, not known to repeat
    assert W._main_text(page, "[]", None, None, None, {-1}) == "ab"
    assert W._main_text("<main><p>a</p></main>", "[]", None, None) == "a"


def test_hosts_without_an_article_region(docs_of):
    rows = [(i, f"http://h.com/{i}", f"<body><div><a href=1>Home</a> <a href=2>About us</a></div><div><h1>Title {i}</h1><p>Body {i} is long enough.</p>"
             + f"<p>More of it {i}</p>" * (i % 3) + "</div><div>All rights reserved here</div></body>") for i in range(8)]
    got = {r.page_id: r.text for r in W.extract(docs_of(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "\n".join([f"Title {i}", f"Body {i} is long enough."] + [f"More of it {i}"] * (i % 3)) for i in range(8)}


def test_folding_and_alignment():
    folded, place = W.fold("a li # /li li # /li li # /li b".split())
    assert folded == ["a", "(", "li", "#", "/li", ")+", "b"] and place == [0, 2, 3, 4, 2, 3, 4, 2, 3, 4, 6]
    one = [(t, False) for t in ["a", "#", "b"]]
    merged, at = W.align(one, [(t, False) for t in ["a", "x", "#", "b"]])
    assert W.expression(merged) == "a x? # b" and at == [0, 1, 2, 3]
    again, _ = W.align(merged, one)
    assert again == merged
    assert json.loads(json.dumps(merged)) == [list(t) for t in merged]


@pytest.mark.parametrize("url,host", [("http://A.com:80/x?y", "a.com:80"), ("https://u@b.org#f", "b.org"), (None, ""), ("nope", "")])
def test_hosts(spark, url, host):
    assert W.host_of(url) == host
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(W._host_column()).first()[0] == host


def test_very_long_conversations_are_read_back_exactly(docs_of):
    from reportkit.llm.chat import conversation_nodes, digests, format_trees
    import hashlib
    rows = [(1, t, "assistant" if t % 2 else "user", ("𝄞é<" if t % 3 else "x") * (t % 50) + str(t)) for t in range(1500)]
    rows += [(2, 0, "assistant", "ß𝄞" * 200_000), (3, 0, "system", None)]
    df = docs_of(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in digests(format_trees(conversation_nodes(df))).collect()}
    for conv in (1, 2, 3):
        told = [(r, t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in told if r == "assistant")
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and got[conv].loss_chars == len(loss)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in told).encode()).hexdigest()
