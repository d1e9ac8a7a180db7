"""Page extraction and vector near duplicates."""

import numpy as np

from panelmill.llm import components, templates, vectors
from panelmill.llm.common import prepare

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">We use</div><main><article><header><h1>Head &amp; line</h1><span>by X</span></header><p>First&nbsp;<b>bold <i>text</b></i>
 goes on<br>here<p>Second &#233;<script>var a="</p>"</script><ul><li>one<li>two</ul><div class="share-buttons">Share</div>
<div>%s</div><aside>Side</aside><form><p>Mail</p></form><section class="comments"><p>Nice!</p></section></article></main><footer>&copy; F</footer>"""


def test_article_without_furniture():
    assert templates.main_text(PAGE % "tail", set()) == "Head & line\n\nFirst bold text goes on here\n\nSecond é\n\none\n\ntwo\n\ntail"
    assert templates.main_text(None, set()) == templates.main_text("", set()) == templates.main_text("<", set()).strip("<") == ""
    assert templates.main_text("plain <b>text", set()) == "plain text"
    assert templates.main_text("<p>a<table><tr><td>b<td>c</table>d", set()) == "a\n\nb\n\nc\n\nd"
    assert templates.main_text("<div>" * 400 + "deep", set()) == "deep"


def test_repeated_subtrees_of_a_host_go(spark):
    own = {k: f"own {k} " + " ".join(f"word{k}x{i}" for i in range(12)) for k in range(0, 44, 4)}
    rows = [(k, f"http://Host.example/{k}", PAGE % own.get(k, "Always this."), "x") for k in range(44)]
    rows += [(100, None, PAGE % "Always this.", "x"), (101, "http://other.example/", PAGE % "Always this.", "x"), (102, "", None, "x"), (0, rows[0][1], rows[0][2], "x")]
    pages = prepare(spark).createDataFrame(rows, "page_id long, url string, html string, host string")
    got = templates.extract(pages).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    # The pages around "Always this." are copies of one article, which has one vote and keeps its own text.
    assert by[4] == own[4] and by[1] == "Always this." and by[100].endswith("two\n\nAlways this.") and by[101] == by[100] and by[102] == ""
    assert templates.extract(pages.where("1 = 0")).isEmpty()


def test_blocks_of_small_hosts_and_of_parts_of_a_host_go(spark):
    def page(k, extra, lang="en"):
        own = f"Story {k} " + " ".join(f"word{k}x{i}" for i in range(30))
        return f'<html lang="{lang}"><body><article><p>{own}</p><div>{extra}</div></article></body></html>', own

    rows, own = [], {}

    def add(host, path, k, *args):
        html, own[len(rows)] = page(k, *args)
        rows.append((len(rows), f"http://{host}/{path}/{k}", html))

    for k in range(5):
        add("small.example", "a", k, "Read our letter.")
    for k in range(60):
        add("large.example", "news" if k % 4 == 0 else f"s{k % 4}", k, "Only in the news." if k % 4 == 0 else f"Of {k}.", "en")
    for k in range(60, 90):
        add("tongues.example", "x", k, "Lisez aussi." if k % 3 == 0 else f"Of {k}.", "fr" if k % 3 == 0 else "en")
    for _ in range(6):
        add("copies.example", "x", 7, "Copied line.")
    for k in range(4):
        add("copies.example", "x", 100 + k, f"Of {k}.")
    got = {r["page_id"]: r["text"] for r in templates.extract(prepare(spark).createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, url, html in rows:
        extra = html.split("<div>")[1].split("</div>")[0]
        kept = extra.startswith("Of ") or "copies" in url
        assert got[i] == own[i] + (f"\n\n{extra}" if kept else ""), url


def test_vectors_by_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 32))
    data = [(c + 0.1 * rng.standard_normal(32)).tolist() for c in centres for _ in range(30)] + rng.standard_normal((200, 32)).tolist()
    rows = [(k, v, k % 2, 1) for k, v in enumerate(data)]
    rows += [(2000 + k, data[4], 0, 1) for k in range(5)] + [(3000, data[4], None, 1), (3001, None, 0, 1), (3002, [], 0, 1), (3003, [0.0] * 32, 0, 1)]
    rows += [(3004, [float("nan")] * 32, 0, 1), (3005, [None, *data[4][1:]], 0, 1), (3006, [float("inf"), *data[4][1:]], 0, 1), (3007, data[4][:16], 0, 1), (None, data[4], 0, 1)]
    frame = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near(frame).collect()}
    good = [(i, np.array(v, dtype=np.float32).astype(float), lab) for i, v, lab, _ in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: [j for j, w, lw in good if j != i and lw == lab and len(w) == len(v) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93] for i, v, lab in good}
    found = sum(got[i][0] for i in links)
    assert sum(map(len, links.values())) * 0.99 <= found <= sum(map(len, links.values()))
    assert got[3000][:2] == (0, 3000) and all(got[k] == (0, k, True) for k in (3001, 3002, 3003, 3004, 3005, 3006, 3007))
    assert got[2004][1] == min(4, *links[4]) if None not in links[4] else got[2004][1] == min(x for x in links[4] if x is not None)
    assert not got[2004][2] and got[None][0] == got[4][0]
    assert vectors.near(frame.where("1 = 0")).isEmpty()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100, 400)] + [(k, 1000) for k in range(900, 999)] + [(5, 5), (7, None), (101, 100)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in got} == {(k, 100) for k in range(100, 401)} | {(k, 900) for k in [*range(900, 999), 1000]}
