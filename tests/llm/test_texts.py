import math
import random
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from wattlane.llm import chat
from wattlane.llm.extract import article_text, extract_pages
from wattlane.llm.lmscore import backoff_scores

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def same_as_sql(frame, **options):
    got = chat.repair(frame, **options).toPandas()
    con = duckdb.connect()
    con.register("conversations", frame.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(chat.oracle_sql()).df()[list(got.columns)]
    a, b = (x.astype({"conv_id": "Int64", "turn": "Int64"}).sort_values(["conv_id", "position"]).reset_index(drop=True).astype(str) for x in (got, want))
    pd.testing.assert_frame_equal(a, b)
    return got


@pytest.mark.parametrize("block", [1024, 3])
def test_repair_equals_sql(spark, block):
    rng = random.Random(1)
    roles = ["user", "assistant", "system", "gpt", " User", "tool", None]
    rows = [(c, t, rng.choice(roles), rng.choice(["hi", "", None]), "k") for c in range(25) for t in range(rng.randint(1, 30))]
    rows += [(None, 0, "user", "lost", "k"), (99, None, "assistant", "late", "k"), (99, 1, "user", "dup", "k"), (99, 1, "user", "dup", "k")]
    same_as_sql(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string"), block=block)


def test_repair_is_cheapest_and_legal(spark):
    rows = [(1, 0, "assistant", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "user", "q"), (2, 1, "assistant", "r")]
    got = chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    text = {r.conv_id: r.text for r in chat.render(got).collect()}
    assert text[2] == "<|user|>\nq\n<|assistant|>\nr\n"
    assert re.sub(r"\n[abc]?\n", " ", text[1]).replace("<|", "").replace("|>", "").split()[-1] == "assistant"
    assert sum(r.cost for r in got.where("conv_id = 1").collect()) == 5
    assert chat.repair(got.select("conv_id", "turn", "role").withColumn("text", got.role).where("false")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x = "<p>no</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu {i}</a></li></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
{open}<h1>Title {i}</h1><p><b>First &amp; foremost&nbsp;{i}<br>next   line{i}<p>Second{i} <i>part{i}</i></p><div class="ad"><p>Buy {i}</p></div>
<form><p>Sign up</p></form><!-- <p>hidden</p> --><ul><li>one{i}<li>two{i}</ul>{close}
<section class="comments"><article><p>reader {i}</p></article></section><aside>Side {i}</aside><footer>&copy; {i}</footer></body></html>"""


def page(i, tag="article"):
    return PAGE.replace("{i}", str(i)).replace("{open}", f"<{tag}>").replace("{close}", f"</{tag.split()[0]}>")


def wanted(i):
    return f"Title {i}\nFirst & foremost {i}\nnext line{i}\nSecond{i} part{i}\none{i}\ntwo{i}"


def test_articles_marked_and_unmarked(spark):
    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(8)] + [(20 + i, f"http://b.org/{i}", page(i, 'div class="body"')) for i in range(8)]
    rows += [(40, "http://c.org/", page(40)), (41, None, page(41)), (42, "not a url", None), (43, "http://a.org/x", ""), (44, "http://a.org/y", "<p>bare"), rows[0]]
    frame = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, host string")
    got = [(r.page_id, r.text, r.n_chars) for r in extract_pages(frame).collect()]
    text = {i: t for i, t, _ in got}
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    for i in [*range(8), 40, 41]:
        assert text[i] == wanted(i)
    for i in range(8):
        assert text[20 + i] == wanted(i)
    assert text[42] == text[43] == "" and text[44] == "bare"
    assert extract_pages(frame.where("false")).count() == 0


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, f"http://a.org/{i}", page(7)) for i in range(9)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {wanted(7)}


def test_repeated_runs_leave_marked_articles_but_copies_stay(spark):
    notice = "<p>Read our new magazine every week</p>"
    rows = [(i, f"http://a.org/{i}", page(i).replace("</article>", notice + "</article>", 1)) for i in range(6)]
    rows += [(10 + i, f"http://b.org/{i}", page(7).replace("</article>", notice + "</article>", 1)) for i in range(6)]
    rows += [(20 + i, f"http://b.org/n{i}", page(20 + i).replace("</article>", notice + "</article>", 1)) for i in range(3)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: wanted(i) for i in range(6)}, **{10 + i: wanted(7) for i in range(6)}, **{20 + i: wanted(20 + i) for i in range(3)}}


def test_broken_markup_does_not_stop_a_page():
    for text in ("<", "<article><p>a <b>b</article><p>c", "<!-- open", "<script>x", "<article>a</p></div>b", "<a <b>", "&#0; &bogus; &lt;"):
        article_text(text, {}, None)
    assert article_text("<article><p>a<p>b", {}, None) == "a\nb"


def test_backoff_equals_counters(docs, no_docs):
    rows = [(r.doc_id, WORD.findall((r.text or "").lower())) for r in docs.collect()]
    one = Counter(w for _, x in rows for w in x)
    two = Counter(p for _, x in rows for p in zip(x, x[1:]))
    n = sum(one.values())
    want = []
    for i, x in rows:
        total = 0.0
        for k, w in enumerate(x):
            if k and two[x[k - 1], w] >= 2:
                total += math.log(two[x[k - 1], w] / one[x[k - 1]])
            else:
                total += (math.log(0.4) if k else 0) + math.log(one[w] / n)
        want.append((-1 if i is None else i, len(x), total if x else 1.0))
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_words, r.log_score or 1.0) for r in backoff_scores(docs).collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-6)
    assert backoff_scores(no_docs).count() == 0


@pytest.mark.parametrize(("order", "least_count"), [(3, 1), (4, 2)])
def test_backoff_of_higher_orders_equals_counters(docs, monkeypatch, order, least_count):
    monkeypatch.setattr("wattlane.llm.lmscore.PART_WORDS", 1000)
    rows = [(-1 if r.doc_id is None else r.doc_id, WORD.findall((r.text or "").lower())) for r in docs.collect()]
    seen = Counter(tuple(x[k : k + m]) for _, x in rows for m in range(1, order + 1) for k in range(len(x) - m + 1))
    n = sum(len(x) for _, x in rows)

    def log_score(gram):
        if len(gram) == 1:
            return math.log(seen[gram] / n)
        if seen[gram] >= least_count:
            return math.log(seen[gram] / seen[gram[:-1]])
        return math.log(0.4) + log_score(gram[1:])

    want = [(i, len(x), sum(log_score(tuple(x[max(0, k - order + 1) : k + 1])) for k in range(len(x))) if x else 1.0) for i, x in rows]
    got = backoff_scores(docs, least_count=least_count, order=order).collect()
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_words, 1.0 if r.log_score is None else r.log_score) for r in got]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9)


def test_wrappers_and_attributes_do_not_hide_the_article(spark):
    body = "<p>First line of it.</p><p class='related-work'>Second line.</p>"
    odd = "<section title=\"the hidden cost\"><p>Third.</p></section><div data-hidden='false' data-x=\"class='ad'\"><p>Fourth.</p></div>"
    pages = [
        f"<html><body><nav>Menu</nav><div class='{c}'><article>{body}{odd}</article><div class='ad'>Buy</div></div></body></html>"
        for c in ("wrapper has-sidebar", "layout no-sidebar", "content ad-free", "plain")
    ]
    pages.append(f"<body><article>{body}{odd}</article><div class='comments'><article><p>A reader says.</p></article></div></body>")
    pages.append(f"<body><article>{body}{odd}<p class='notice'>We use cookies.</p><div hidden><p>No.</p></div></article></body>")
    rows = [(i, f"http://h{i}.example/a", p) for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(got.values()) == {"First line of it.\nSecond line.\nThird.\nFourth."}


def test_the_backoff_query_backs_off(spark, docs, tmp_path):
    from wattlane.llm.queries import QUERIES

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.log_score for r in QUERIES["op8_backoff_scores"](spark, str(tmp_path)).collect()}
    # Every trigram of the documents is seen once at least, so with a least count of 1 none would back off.
    scores = {n: {r.doc_id: r.log_score for r in backoff_scores(docs, least_count=n, order=3).collect()} for n in (1, 2)}
    assert got == {k: None if v is None else pytest.approx(v, abs=1e-3) for k, v in scores[2].items()}
    assert sum(v is not None and abs(v - scores[1][k]) > 0.1 for k, v in got.items()) > 20


def shuffled_bytes(frame):
    """Bytes that the exchanges of a collected frame have written."""

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "ReusedExchangeExec":
            return 0
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        own = plan.metrics().apply("shuffleBytesWritten").value() if name == "ShuffleExchangeExec" else 0
        children = plan.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(frame._jdf.queryExecution().executedPlan())


def test_backoff_shuffles_little_more_than_the_hashes(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(60_000)]
    rows = [(i, " ".join(rng.choices(words, k=400))) for i in range(500)]
    scores = backoff_scores(spark.createDataFrame(rows, "doc_id long, text string"), order=3)
    assert len(scores.collect()) == 500
    # 200,000 words that are mostly different: some 600,000 n-grams of less than 6 bytes, the texts and the answers once.
    assert 0 < shuffled_bytes(scores) < 6 * 2.9 * 200_000 + 3_200_000 / 2 + 200_000


def test_backoff_without_words(spark):
    rows = [(1, ""), (2, None), (3, "!!! ?"), (None, " ")]
    got = backoff_scores(spark.createDataFrame(rows, "doc_id long, text string"), order=3).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.log_score, r.mean_log_score) for r in got) == [(i, 0, None, None) for i in range(4)]
