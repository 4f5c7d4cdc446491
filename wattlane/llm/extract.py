"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its tags (with the path of elements above) and its text runs (with the
path of the element). Per host:

1. Every token's occurrence vector over the pages is kept as (pages, sum of hashes of page and
   count), which adds up map-side; tokens with equal vectors are an equivalence class. Only tokens on
   half of a host's pages, and three of them, can be of a template.
2. A class is valid if its tokens come in one order on all pages that have it. The valid class of all
   pages with the most tokens is the root; another valid class is nested in the root's gap in which all of
   its occurrences lie, on every page, or left out.
3. Gaps between template tokens are slots. Of the elements that the root has once a page, the article is
   the one named so, else a main element, else the one with most variable text whose
   elements below hold less than 60 % of it. Slot text inside it is extracted; elements marked as menus, headers,
   footers, sidebars, notices, adverts, forms or comments are not, nor are text runs that are template tokens. In
   an article that is marked as one they can be copies of an article, so there a run is of the template
   only if it occurs with at least three different remainders, which are the article's text without such runs.

A host with fewer than three pages, and a page that lacks its host's article element, go by the page alone.
A page's blocks end where a block element starts or ends and at line breaks.

Null html: empty text. Null or odd url: the host is empty text, a host of its own without template.
Repeated rows: one result each. Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Container, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of
from wattlane.llm.markup import Event, events
from wattlane.session import materialize

LEAST_PAGES = 3
LEAST_SHARE = 0.5
LEAST_REMAINDERS = 3
# Rows of (host, token) up to which the templates are sent to all tasks rather than shuffled.
SENT_TOKENS = 200_000


@lru_cache(maxsize=100_000)
def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def token_of(e: Event) -> int | None:
    if e.kind == "text":
        run = " ".join(e.text.split())
        key = f"{e.path}\x1f{run}"
        if not run:
            return None
        return _hash(key) if len(run) < 80 else _hash.__wrapped__(key)
    return None if e.kind == "break" else _hash(f"{e.kind}{e.path}")


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def pages_of(df: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty), host and a key for each distinct page."""
    rows = df.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return rows.withColumn("host", host).withColumn("page_key", F.xxhash64("page_id", "url", F.length("html")))


def occurrence_vectors(pages: DataFrame) -> DataFrame:
    """(host, token, pages, vector) of all tokens; the row of token 0 counts the host's pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, int], list[int]] = {}
            columns = (column_of(batch, k).to_pylist() for k in ("host", "page_key", "html"))
            for host, key, page in zip(*columns):
                tokens = Counter(t for e in events(page) if (t := token_of(e)) is not None)
                tokens[0] = 1
                for token, n in tokens.items():
                    at = total.setdefault((host, token), [0, 0])
                    at[0] += 1
                    at[1] += hash((key, n))
            hosts, tokens = zip(*total) if total else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hosts, pa.string()),
                    pa.array(tokens, pa.int64()),
                    pa.array([v[0] for v in total.values()], pa.int64()),
                    pa.array([_signed(v[1]) >> 20 for v in total.values()], pa.int64()),
                ],
                ["host", "token", "pages", "vector"],
            )

    found = pages.where("host != ''").select("host", "page_key", "html").mapInArrow(count, "host string, token long, pages long, vector long")
    return found.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("vector").alias("vector"))


def _with_template(pages: DataFrame, template: DataFrame) -> DataFrame:
    """Pages with their host's (token, class) pairs; the templates are sent along only if they are small."""
    by_host = template.groupBy("host").agg(F.collect_list("token").alias("tokens"), F.collect_list("class").alias("classes"))
    if template.count() <= SENT_TOKENS:
        by_host = F.broadcast(by_host)
    return pages.join(by_host, "host", "left")


def _with_article(pages: DataFrame, article: DataFrame) -> DataFrame:
    return pages.join(F.broadcast(article) if article.count() <= SENT_TOKENS else article, "host", "left")


def _page_template(batch: pa.RecordBatch, i: int) -> dict[int, int]:
    tokens = column_of(batch, "tokens")[i].as_py() or ()
    return dict(zip(tokens, column_of(batch, "classes")[i].as_py() or ()))


def templates(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(host, token, class) of the templates, (host, article), the token of each host's article element, and
    (host, token) of the template's text runs in elements marked as an article.

    Class 0 is the root, others are nested in one of its gaps.
    """
    vectors = materialize(occurrence_vectors(pages), "vectors")
    size = vectors.where("token = 0").select("host", F.col("pages").alias("host_pages"))
    often = vectors.where("token != 0").join(size, "host").where(
        (F.col("pages") >= F.greatest(F.lit(LEAST_PAGES), F.ceil(F.col("host_pages") * LEAST_SHARE)))
    )
    # Classes are told apart by (pages, vector); the root is the largest of those on all pages.
    classes = often.groupBy("host", "pages", "vector").agg(
        F.count("*").alias("n"), (F.first("host_pages") == F.col("pages")).alias("full")
    )
    root = classes.where("full").groupBy("host").agg(F.max_by("vector", F.struct("n", "vector")).alias("root"))
    named = often.join(root, "host").select(
        "host", "token", F.when(F.col("vector") == F.col("root"), 0).otherwise(F.xxhash64("pages", "vector")).alias("class")
    )
    template = materialize(named, "classes")

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders: dict[tuple[str, int], list[int]] = {}
            weights: dict[tuple[str, int], list[int]] = {}
            runs: set[tuple[str, int]] = set()
            for i, (host, page) in enumerate(zip(column_of(batch, "host").to_pylist(), column_of(batch, "html").to_pylist())):
                _examine_page(host, page, _page_template(batch, i), orders, weights, runs)
            rows = [(h, 0, k, *v, 0) for (h, k), v in orders.items()] + [(h, 1, k, *v) for (h, k), v in weights.items()]
            rows += [(h, 2, k, 0, 0, 0) for h, k in runs]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * 4]
            names = ["host", "kind", "id", "low", "high", "words"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    given = _with_template(pages.select("host", "html"), template).where("tokens IS NOT NULL")
    schema = "host string, kind int, id long, low long, high long, words long"
    seen = given.mapInArrow(examine, schema).groupBy("host", "kind", "id").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("low").alias("main"), F.sum("words").alias("words")
    )
    seen = materialize(seen, "examined")
    valid = seen.where("kind = 0 AND low = high AND low != -1").select("host", F.col("id").alias("class"))
    template = materialize(template.join(valid, ["host", "class"]).select("host", "token", "class"), "templates")
    weights = seen.where("kind = 1").select("host", F.col("id").alias("token"), "main", F.col("high").alias("depth"), "words")
    weights = weights.join(template.where("class = 0").select("host", "token"), ["host", "token"])
    most = weights.groupBy("host").agg(F.max("words").alias("most"))
    able = weights.join(most, "host").withColumn("holds", F.col("words") >= 0.6 * F.col("most"))
    best = F.max_by("token", F.struct("holds", "main", "depth", "token"))
    article = able.where((F.col("main") > 0) | F.col("holds")).groupBy("host").agg(best.alias("article"))
    runs = seen.where("kind = 2").select("host", F.col("id").alias("token")).join(template.select("host", "token"), ["host", "token"])
    return template, materialize(article, "articles"), materialize(runs, "marked-runs")


def repeated_in_marked(pages: DataFrame, template: DataFrame, article: DataFrame, runs: DataFrame) -> DataFrame:
    """(host, token) of the ``runs`` that occur with enough different remainders of marked articles."""
    given = _with_template(pages.select("host", "html").join(runs.select("host").distinct(), "host", "left_semi"), template)
    given = _with_article(given, article)

    def remainders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for i, (host, page) in enumerate(zip(column_of(batch, "host").to_pylist(), column_of(batch, "html").to_pylist())):
                template = _page_template(batch, i)
                seen, chosen = _article_of(page, column_of(batch, "article")[i].as_py())
                if any(e.main for e in chosen):
                    tokens = {t for e in _text_events(seen, chosen) if e.kind == "text" and (t := token_of(e)) in template}
                    if tokens:
                        rest = _hash.__wrapped__(_blocks(seen, chosen, template))
                        found.update((host, t, rest) for t in tokens)
            columns = list(zip(*found)) if found else [()] * 3
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["host", "token", "rest"])

    rests = given.mapInArrow(remainders, "host string, token long, rest long").distinct()
    return rests.groupBy("host", "token").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_REMAINDERS).select("host", "token")


def _examine_page(
    host: str,
    page: str,
    names: dict[int, int],
    orders: dict[tuple[str, int], list[int]],
    weights: dict[tuple[str, int], list[int]],
    runs: set[tuple[str, int]],
) -> None:
    """Add up the order and gap of the page's classes, and the variable words inside the root's elements.

    ``orders`` holds the least and greatest hash of (order of tokens, gap) of a class, -1 if it is in several
    gaps; ``weights`` whether the element is called an article, its depth, and its words; ``runs`` the text runs of classes in marked elements.
    """
    order: dict[int, list[int]] = {}
    gaps: dict[int, set[int]] = {}
    inside: list[int] = []
    marked: list[bool] = []
    gap = 0
    for e in events(page):
        token = token_of(e)
        kind = names.get(token)
        if e.kind == "open":
            marked.append(e.main > 0)
        elif e.kind == "close" and marked:
            marked.pop()
        elif e.kind == "text" and kind is not None and not e.dropped and any(marked):
            runs.add((host, token))
        if kind is not None:
            gap += kind == 0
            order.setdefault(kind, []).append(token)
            gaps.setdefault(kind, set()).add(gap)
        if e.kind == "open":
            inside.append(token if kind == 0 and not e.dropped else 0)
            if inside[-1]:
                weights.setdefault((host, token), [e.main, e.path.count("/"), 0])
        elif e.kind == "close" and inside:
            inside.pop()
        elif e.kind == "text" and not e.dropped and kind is None and token is not None:
            n = e.text.count(" ") + 1
            for own in inside:
                if own:
                    weights[(host, own)][2] += n
    for kind, seen in order.items():
        first = tuple(dict.fromkeys(seen))
        where = hash(first) >> 8
        if kind:
            where = hash((first, min(gaps[kind]))) >> 8 if len(gaps[kind]) == 1 else -1
        at = orders.setdefault((host, kind), [where, where])
        at[0], at[1] = min(at[0], where), max(at[1], where)


def _article_of(page: str, article: int | None) -> tuple[list[Event], list[Event]]:
    """The page's events, and those that open its article (none: the whole page)."""
    found = list(events(page))
    chosen = [e for e in found if e.kind == "open" and not e.dropped and article is not None and token_of(e) == article]
    if not chosen:
        level = max((e.main for e in found), default=0)
        chosen = [e for e in found if e.kind == "open" and e.main == level and level]
    return found, chosen


def _text_events(found: list[Event], chosen: list[Event]) -> Iterator[Event]:
    """The text runs of the article, and the other events of the page."""
    roots = {id(e) for e in chosen}
    depth = 0
    inside: list[bool] = []
    for e in found:
        if e.kind == "text":
            if (depth or not chosen) and not e.dropped:
                yield e
            continue
        yield e
        if e.kind == "open":
            inside.append(id(e) in roots)
            depth += inside[-1]
        elif e.kind == "close" and inside:
            depth -= inside.pop()


def _blocks(found: list[Event], chosen: list[Event], repeated: Container[int]) -> str:
    blocks: list[str] = []
    now: list[str] = []

    def close() -> None:
        if block := " ".join("".join(now).split()):
            blocks.append(block)
        now.clear()

    for e in _text_events(found, chosen):
        if e.kind != "text":
            close()
        elif not (repeated and token_of(e) in repeated):
            now.append(e.text)
    close()
    return "\n".join(blocks)


def article_text(page: str, template: dict[int, int], article: int | None, marked: Container[int] = ()) -> str:
    """Blocks of the page's article, one a line; ``marked`` are the runs left out of one that is marked."""
    found, chosen = _article_of(page, article)
    return _blocks(found, chosen, marked if any(e.main for e in chosen) else template)


def extract_pages(df: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = pages_of(df)
    template, article, runs = templates(pages)
    given = _with_article(_with_template(pages, template), article)
    if runs.isEmpty():
        given = given.withColumn("marked", F.array().cast("array<long>"))
    else:
        repeated = materialize(repeated_in_marked(pages, template, article, runs), "marked-templates")
        by_host = repeated.groupBy("host").agg(F.collect_list("token").alias("marked"))
        given = given.join(F.broadcast(by_host) if repeated.count() <= SENT_TOKENS else by_host, "host", "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for i, page in enumerate(column_of(batch, "html").to_pylist()):
                marked = frozenset(column_of(batch, "marked")[i].as_py() or ())
                texts.append(article_text(page, _page_template(batch, i), column_of(batch, "article")[i].as_py(), marked))
            columns = [column_of(batch, "page_id"), column_of(batch, "url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kept = given.select("page_id", "url", "html", "tokens", "classes", "article", "marked")
    return kept.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
