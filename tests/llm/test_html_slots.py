"""Slots of the host's wrapper choose the text where tags and classes leave it open."""

from reportkit.llm import wrappers as W

KINDS = "page_id long, url string, html string"


def test_the_host_decides_names_in_doubt(docs_of):
    def page(i):
        return (f'<article><h1>T{i}</h1><div class="promo"><p>body {i} one</p><p>body {i} two</p></div><div class="share"><p>Tell a friend</p><p>Print</p></div>'
                f'<div class="breadcrumbs"><p><a href=1>at {i}</a></p></div><div class="comments"><p>comment {i}</p></div></article>')
    rows = [(i, "http://h.com/", page(i)) for i in range(8)] + [(100, "http://one.com/", page(100))]
    got = {r.page_id: r.text for r in W.extract(docs_of(rows, KINDS)).collect()}
    assert got == {**{i: f"T{i}\nbody {i} one\nbody {i} two" for i in range(8)}, 100: "T100\nbody 100 one\nbody 100 two"}


def test_main_beside_an_article_stays_if_it_varies(docs_of):
    rows = [(i, "http://h.com/", f"<main><h1>Title {i}</h1><h2>More</h2><article><p>text {i}</p>" + "<ul><li>x</ul>" * (i % 2) + "</article><p><a href=1>next {i}</a></p></main>")
            for i in range(8)]
    got = {r.page_id: r.text for r in W.extract(docs_of(rows, KINDS)).collect()}
    assert got == {i: f"Title {i}\ntext {i}" + "\nx" * (i % 2) for i in range(8)}


def test_slots_do_not_mix_regions():
    page = '<p>a</p><main><p>b</p><article><p>c</p><div class="share">d</div></article></main><div class="ad">e</div>'
    assert [t for t in W.read(page)[0] if t[0] == "#"] == ["#", "#m", "#a", "#~a", "#!"]


def test_copies_of_one_article_keep_their_text(docs_of):
    rows = [(i, "http://h.com/", "<nav>n</nav><article><p>same</p></article>") for i in range(9)]
    assert {r.text for r in W.extract(docs_of(rows, KINDS)).collect()} == {"same"}


def test_a_weak_name_needs_no_host_to_keep_its_text_and_repeated_texts_lose_it(docs_of):
    page = '<article><h1>T{0}</h1><div class="promo-box"><p>{1}</p></div></article>'
    rows = [(0, "http://one.com/", page.format(0, "body"))] + [(10 + i, "http://two.com/", page.format(i, f"body {i}")) for i in range(2)]
    rows += [(20 + i, "http://same.com/", page.format(i, "Buy now")) for i in range(2)]
    rows += [(30, "http://link.com/", page.format(0, "<a href=1>All offers</a> here"))]
    got = {r.page_id: r.text for r in W.extract(docs_of(rows, KINDS)).collect()}
    assert got == {0: "T0\nbody", 10: "T0\nbody 0", 11: "T1\nbody 1", 20: "T0", 21: "T1", 30: "T0"}


def test_slots_decide_not_names(docs_of):
    """The same pages read with and without their host's wrapper."""
    page = '<article><h1>T{0}</h1><div class="share"><p>kept {0} as it varies</p></div><div class="toolbar-x"><p>Print</p></div></article>'
    rows = [(i, "http://h.com/", page.format(i)) for i in range(4)]
    got = {r.page_id: r.text for r in W.extract(docs_of(rows, KINDS)).collect()}
    assert got == {i: f"T{i}\nkept {i} as it varies" for i in range(4)}
    assert {i: W._main_text(h, "[]", None, None) for i, _, h in rows} == {i: f"T{i}\nPrint" for i in range(4)}


def brute_slots(rows):
    """Verdicts of slots from all texts of a host at once: (free, worn) by plain counting."""
    from collections import Counter, defaultdict
    texts, pages, linked = defaultdict(list), defaultdict(set), defaultdict(list)
    for page_id, blocks in rows:
        asked = W._asked(b[3] for b in blocks)
        for slot, text, n, token, _ in blocks:
            if token in asked and token != "#" and slot >= 0:
                texts[slot].append(text)
                pages[slot].add(page_id)
                linked[slot].append((n, len(text)))
    free, worn = set(), set()
    for slot, t in texts.items():
        links = 2 * sum(n for n, _ in linked[slot]) > sum(n for _, n in linked[slot])
        most = Counter(t).most_common(1)[0][1]
        if links or (most >= 2 and most * 2 > len(t)):
            worn.add(slot)
        if len(pages[slot]) >= 3 and len(set(t)) * 2 > len(t) and not links:
            free.add(slot)
    return free, worn


def test_slot_verdicts_are_those_of_plain_counting(docs_of):
    import json
    import random
    rng = random.Random(4)
    names = ["share", "promo-x", "toolbar", "notice", "", "widget y"]
    rows = []
    for i in range(60):
        parts = "".join(f'<div class="{c}"><p>{rng.choice([f"v{i}", "same", "<a href=1>go</a>"])}</p></div>' for c in rng.choices(names, k=4))
        rows.append((i, f"http://h{i % 5}.com/", f"<main><h2>m{i % 3}</h2><article><h1>t{i}</h1>{parts}</article></main>"))
    docs = docs_of(rows, KINDS)
    hosts = {r.host: r.wrapper for r in W.infer(docs).collect()}
    keyed = docs.select("html", W._host_column().alias("host"))
    table = docs.sparkSession.sparkContext.broadcast({h: (w,) for h, w in hosts.items()})
    got = {r.host: (set(r.free), set(r.worn)) for r in W.slot_facts(keyed, table).collect()}
    for h, w in hosts.items():
        assert got[h] == brute_slots([(i, W.slotted(page, w)) for i, u, page in rows if W.host_of(u) == h])
    assert any(f for f, _ in got.values()) and any(w for _, w in got.values())
    # a join instead of a shared table gives the same
    spark = docs.sparkSession
    joined = keyed.join(spark.createDataFrame(list(hosts.items()), "host string, wrapper string"), "host")
    assert {r.host: (set(r.free), set(r.worn)) for r in W.slot_facts(joined).collect()} == got
    assert json.loads(hosts["h0.com"])


def test_shared_and_joined_wrappers_give_one_result(docs_of, monkeypatch):
    rows = [(i, f"http://h{i % 3}.com/", f'<article><h1>T{i}</h1><div class="share">{"x" if i % 2 else i}</div></article>') for i in range(12)] + [(99, None, None)]
    docs = docs_of(rows, KINDS)
    one = sorted((r.page_id, r.text) for r in W.extract(docs).collect())
    monkeypatch.setattr(W, "BROADCAST_BYTES", 0)
    assert sorted((r.page_id, r.text) for r in W.extract(docs).collect()) == one
