"""HTML extraction: equivalence-class template deduction.

Pages of one host come from one template. A token (an element's start or end at its path, or
a text at its path) has an occurrence vector over the host's pages: how often it occurs on
each. Tokens with equal vectors form an equivalence class; a class that is large and on
nearly all pages of its host, and whose tokens come in the same order on each page, is part
of the template. Classes nest: a class whose span lies in a gap of another belongs to that
gap; one that straddles a gap is discarded.

The accepted tokens of a page cut it into gaps, the template's slots, each named by the two
tokens around it. A slot is judged over all pages of its host: it has content if its texts
differ from page to page (on a few pages, they need not) and are mostly not links. The article is the smallest container of
the template that holds nearly all words of the content slots, and what a page has in that
container's content slots is its text. (An article or main element around it, and a top
heading before it, belong to it.) What class names mark as comments, adverts and so on is left out.

A vector is summed up by (pages, occurrences, sum of hash(page, count)), which merges by
aggregation, so a host with a third of all pages costs a row per task and token, and no
host's pages meet in one task. A host with a single page shows no template; there, and on
pages that lack their host's article container, element and class names tell the article.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .html_page import CONTAINERS, Text, blocks, clean, joined, scan

MIN_PAGES = 2  # pages of a host from which a template can be told from content
TEXT_PAGES = 4  # pages with the same text in a place, or with a slot, from which that tells something
MIN_CLASS = 3  # tokens of a class
SHARE = 0.9  # of the host's pages that a class is on
VARIED = 0.1  # different texts of a content slot for each page that has one, at least
LINKED = 0.5  # of a content slot's words that are links, less than
ARTICLE = 0.7  # of the content slots' words that the article's container holds


def role_hash(path: str, value: str = "") -> int:
    return int.from_bytes(hashlib.blake2b(f"{path}\0{value}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class TagHashes(dict):
    """role_hash of element paths, which recur on every page of a template."""

    def __missing__(self, path: str) -> int:
        if len(self) >= 1 << 16:
            self.clear()
        self[path] = value = role_hash(path)
        return value


def tokens(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """host, page, role, n (occurrences on the page), at (place of the first), is_text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = TagHashes()
        for batch in batches:
            out: list[tuple] = []
            for host, page, text in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html"))):
                tags, texts = scan(text)
                seen: dict[int, list[int]] = {}
                for at, path in tags:
                    seen.setdefault(tag[path], [0, at])[0] += 1
                for t in texts:
                    if value := clean(t.value):
                        seen.setdefault(role_hash(t.path, value), [0, t.at, True])[0] += 1
                out += [(host, page, r, n, at, bool(is_text)) for r, (n, at, *is_text) in seen.items()]
            columns = [*zip(*out)] or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()))],
                names=["host", "page", "role", "n", "at", "is_text"])

    lean = pages.select(F.col("host"), F.xxhash64(id_col, url_col, html_col).alias("page"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return lean.mapInArrow(run, "host string, page long, role long, n int, at int, is_text boolean")


def templates(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """host and roles (array): the tokens of its valid classes. ``pages`` has ``host``."""
    found = stored(tokens(pages, id_col, url_col, html_col), "page_tokens")
    vectors = found.groupBy("host", "role").agg(
        F.count("*").alias("pages"), F.max("is_text").alias("is_text"), F.sum("n").alias("n"),
        F.sum(F.xxhash64("page", "n").bitwiseAND(F.lit((1 << 40) - 1))).alias("vector"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("host_pages")).where(F.col("host_pages") >= MIN_PAGES)
    frequent = stored(vectors.join(hosts, "host").where(F.col("pages") >= SHARE * F.col("host_pages"))
                      .where(F.col("pages") >= F.when(F.col("is_text"), TEXT_PAGES).otherwise(1))
                      .withColumn("class", F.xxhash64("pages", "n", "vector")).select("host", "role", "pages", "class"),
                      "page_classes")
    large = frequent.groupBy("host", "class").agg(F.count("*").alias("size")).where(F.col("size") >= MIN_CLASS)
    members = stored(frequent.join(large, ["host", "class"], "left_semi"), "page_members")
    # the order of a class's tokens on each page (a set, as repeated rows are one page): equal
    # sequences have equal hashes
    placed = found.join(members, ["host", "role"]).groupBy("host", "class", "page").agg(
        F.sort_array(F.collect_set(F.struct("at", "role"))).alias("sequence"))
    ordered = placed.groupBy("host", "class").agg(
        F.min(F.xxhash64(F.col("sequence.role"))).alias("low"), F.max(F.xxhash64(F.col("sequence.role"))).alias("high"),
        F.avg(F.element_at("sequence", 1)["at"]).alias("first")).where("low = high")
    return members.join(ordered, ["host", "class"]).groupBy("host").agg(
        F.collect_list(F.struct("class", "role")).alias("members"))


def nested(members: dict[int, int], places: dict[int, int]) -> set[int]:
    """The roles of the classes that nest on a page. ``members`` maps a role to its class,
    ``places`` a role to its first place. Larger spans come first; a class whose span is cut
    by a token of an accepted class without lying in one of its gaps is discarded."""
    classes: dict[int, list[tuple[int, int]]] = {}
    for role, group in members.items():
        if role in places:
            classes.setdefault(group, []).append((places[role], role))
    accepted: set[int] = set()
    gaps: list[list[int]] = []
    for group in sorted(classes.values(), key=lambda g: min(g)[0] - max(g)[0]):
        spots = sorted(p for p, _ in group)
        inside = lambda outer: sum(a < spots[0] for a in outer) == sum(a < spots[-1] for a in outer)
        around = lambda outer: spots[0] <= outer[0] and outer[-1] <= spots[-1]
        if all(inside(o) or around(o) for o in gaps):
            gaps.append(spots)
            accepted.update(r for _, r in group)
    return accepted


class Slots:
    """A page cut at its accepted tokens. ``members`` maps the host's template roles to classes."""

    def __init__(self, page: str, members: dict[int, int], tag: TagHashes):
        self.tags, self.texts = scan(page)
        places: dict[int, int] = {}
        for at, path in self.tags:
            places.setdefault(tag[path], at)
        self.values = [clean(t.value) for t in self.texts] if members else []
        self.roles = [role_hash(t.path, v) if v else 0 for t, v in zip(self.texts, self.values)] if members else [0] * len(self.texts)
        for role, t in zip(self.roles, self.texts):
            if role:
                places.setdefault(role, t.at)
        self.template = nested(members, places) if members else set()
        self.places = places
        cuts = sorted((places[r], r) for r in self.template)
        self.bounds = [at for at, _ in cuts]
        around = [0, *(r for _, r in cuts), 0]
        self.names = [_pair(a, b) for a, b in zip(around, around[1:])]  # of the gap before each cut, and the last

    def gap(self, t: Text) -> int:
        return bisect_right(self.bounds, t.at)

    def filled(self) -> dict[int, list]:
        """By slot: words, words in links, and the text, of those that have any."""
        out: dict[int, list] = {}
        for role, t, value in zip(self.roles, self.texts, self.values):
            if role and t.seen and role not in self.template:
                slot = out.setdefault(self.names[self.gap(t)], [0, 0, []])
                words = value.count(" ") + 1
                slot[0] += words
                slot[1] += words * t.linked
                slot[2].append(value)
        return out

    def article(self, content: dict[int, int], tag: TagHashes) -> list[Text] | None:
        """The texts of the content slots (words by slot) in the article's container; None
        where this page has no such container."""
        upto = [*accumulate((content.get(name, 0) for name in self.names), initial=0)]
        starts: dict[str, int] = {}
        best = None
        for at, path in self.tags:
            if not path.endswith("/end"):
                if path.rpartition("/")[2].partition(".")[0].partition("[")[0] in CONTAINERS and tag[path] in self.template:
                    starts.setdefault(path, at)
                continue
            start = starts.get(path[:-4])
            if start is None or tag[path] not in self.template or self.places[tag[path]] != at:
                continue
            held = upto[bisect_right(self.bounds, at - 1) + 1] - upto[bisect_right(self.bounds, start)]
            if held and held >= ARTICLE * upto[-1] and (best is None or at - start < best[1] - best[0]):
                best = (start, at, path[:-4])
        if best is None:
            return None
        start, end, path = best
        own = [t for r, t in zip(self.roles, self.texts) if t.seen and not t.chrome and r not in self.template
               and (not r or self.names[self.gap(t)] in content)]
        whole = _outer(path)
        inside = [t for t in own if start < t.at < end or (whole and (t.path + "/").startswith(whole))]
        if not any("/h1" in t.path for t in inside):
            inside = [t for t in own if t.at < start and "/h1" in t.path and not t.linked] + inside
        return inside


def _outer(path: str) -> str:
    """The path of the innermost article or main element at or around ``path``, with a slash."""
    parts = path.split("/")
    for k in range(len(parts) - 1, 0, -1):
        if parts[k].partition(".")[0].partition("[")[0] in ("article", "main"):
            return "/".join(parts[:k + 1]) + "/"
    return ""


def _pair(a: int, b: int) -> int:
    """The name of the slot between two tokens."""
    return (a * 0x9E3779B97F4A7C15 + b * 3 + 1 + (1 << 63)) % (1 << 64) - (1 << 63)


def slots(pages: DataFrame, known: DataFrame) -> DataFrame:
    """host and content (array of slot, words): the slots that have the host's content.
    ``pages`` has host and html, ``known`` the hosts' templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = TagHashes()
        for batch in batches:
            out: list[tuple] = []
            for host, page, members in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "members"))):
                cut = Slots(page, {m["role"]: m["class"] for m in members}, tag)
                out += [(host, slot, role_hash("", "\n".join(text)), words, linked)
                        for slot, (words, linked, text) in cut.filled().items()]
            columns = [*zip(*out)] or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                names=["host", "slot", "text", "words", "linked"])

    filled = (pages.join(known, "host").select("host", F.coalesce("html", F.lit("")).alias("html"), "members")
              .mapInArrow(run, "host string, slot long, text long, words long, linked long"))
    texts = filled.groupBy("host", "slot", "text").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.sum("linked").alias("linked"))
    return (texts.groupBy("host", "slot").agg(F.count("*").alias("different"), F.sum("n").alias("n"), F.sum("words").alias("words"),
                                              F.sum("linked").alias("linked"))
            .where(((F.col("n") < TEXT_PAGES) | (F.col("different") >= F.greatest(F.lit(2), VARIED * F.col("n"))))
                   & (F.col("linked") < LINKED * F.col("words")))
            .groupBy("host").agg(F.collect_list(F.struct("slot", "words")).alias("content")))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            use_template: bool = True) -> DataFrame:
    """Per row: the id, url, text (the article's blocks joined by a line feed; empty if
    none) and n_chars.

    A null html is an empty page. A null or odd url has the host of the empty name. Repeated
    rows stay, and each counts as a page of its host; on a host whose pages are all alike nothing counts as template. Other columns
    are ignored; an empty table gives an empty result. Without ``use_template`` element and
    class names alone decide.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    hosted = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                          F.col(html_col).alias("html"), host.alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = TagHashes()
        for batch in batches:
            out = []
            for page, members, content in zip(*(batch.column(c).to_pylist() for c in ("html", "members", "content"))):
                cut = Slots(page or "", {m["role"]: m["class"] for m in members or ()}, tag)
                found = joined(cut.article({c["slot"]: c["words"] for c in content}, tag) or []) if content else []
                if not found:
                    roles = {id(t): r for r, t in zip(cut.roles, cut.texts)}
                    found = blocks(cut.texts, cut.template, lambda t: roles[id(t)])
                out.append("\n".join(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(out, pa.string()), pa.array([*map(len, out)], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    types = f"`{id_col}` long, `{url_col}` string, text string, n_chars long"
    if not use_template:
        none = [F.lit(None).cast("array<struct<class long, role long>>").alias("members"),
                F.lit(None).cast("array<struct<slot long, words long>>").alias("content")]
        return hosted.select("id", "url", "html", *none).mapInArrow(run, types)
    known = stored(templates(hosted, "id", "url", "html"), "page_templates")
    content = stored(slots(hosted, known), "page_slots")
    return (hosted.join(known.join(content, "host", "left"), "host", "left")
            .select("id", "url", "html", "members", "content").mapInArrow(run, types))
