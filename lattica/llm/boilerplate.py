"""Main text of web pages: what repeats across a host's distinct pages is found with a suffix array and removed.

Streams.  Everything on a page outside its article (all of it where no markup names one) becomes one
token stream: a mark for each block, its words, a mark where the article stood.  A host's streams,
laid end to end, are the string of its suffix array.

The suffix array.  Only substrings of at least LONG tokens matter, so suffixes are sorted to that
depth, by prefix doubling (names of length 1, 2, 4, 8 tokens; a name is a hash, so doubling needs no
exchange).  Suffixes that share their first LONG tokens are neighbours: an exchange by host and name
brings them together, and the union of the repeated LONG-token windows is exactly the union of all
longer repeats.  A host's array is spread over the whole cluster; nothing gathers a host.

Distinct pages.  Copies of a page would make its own text look repeated.  So every page brings the
digests of its three longest blocks of article or open text, and a window is repeated if two of the
three differ among the pages it stands on; pages that share them are copies of one page.  Streams that
are equal are merged before suffixes are made, so a footer on a million pages is one stream.

Verdicts.  Article blocks stay.  Blocks that the markup calls surroundings go.  Of open blocks (pages
without article markup) the words that repeats cover go and the unique runs stay.
"""

from __future__ import annotations

import heapq

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import dropped, slices, written
from lattica.llm.html_blocks import ARTICLE, AROUND, OPEN, blocks
from lattica.llm.shingles import mixed

#: Tokens of a substring that counts as long: a power of two.
LONG = 8
#: Marks before and behind a stream, so that half as many tokens are enough at its ends.
ENDS = LONG // 2
WHOLE = "\x02"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def digest32(text: str) -> int:
    return xxhash.xxh32_intdigest(text.encode()) - (1 << 31)


def stream(page: list) -> str:
    """The token stream as text, tokens joined by line feeds (no token holds one)."""
    out, inside = [WHOLE] * ENDS, False
    for b in page:
        if b.kind == ARTICLE:
            if not inside:
                out.append("<article>")
            inside = True
        else:
            inside = False
            out.append(f"<{b.tag}>")
            out += b.text.split()
    return "\n".join(out + [WHOLE] * ENDS)


def identities(page: list) -> list[int]:
    """Digests of the three longest blocks of article or open text; the digest of all of it where there are fewer."""
    own = [b.text for b in page if b.kind != AROUND]
    most = heapq.nlargest(3, own, key=lambda t: (len(t), t))
    return [digest32(t) for t in most] + [digest32("\n".join(own))] * (3 - len(most))


def key_of(host: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"{host}\n{text}".encode())


def names(streams: list[str], hosts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name of every suffix with LONG tokens or more, its stream's number and its place in the stream."""
    seen: dict[str, int] = {}
    ids, size = [], []
    for s in streams:
        tokens = s.split("\n")
        size.append(len(tokens))
        ids += [seen.setdefault(t, len(seen)) for t in tokens]
    h = np.array([xxhash.xxh64_intdigest(t.encode()) for t in seen], dtype=np.uint64)[np.array(ids, dtype=np.int64)]
    k = 1
    while k < LONG:  # the name of 2k tokens is made of those of the first and the last k
        h = mixed(h[:-k] + mixed(h[k:] + np.uint64(k))) if len(h) > k else h[:0]
        k *= 2
    size = np.array(size, dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    which = np.repeat(np.arange(len(size)), size)[: len(h)]
    place = np.arange(len(h)) - start[which]
    fits = place + LONG <= size[which]
    host = np.array([xxhash.xxh64_intdigest(x.encode()) for x in hosts], dtype=np.uint64)
    return mixed(h[fits] ^ host[which[fits]]).view(np.int64), which[fits], place[fits]


IDENTITIES = [f"{end}{i}" for i in range(3) for end in ("lo", "hi")]


def merged() -> list:
    return [(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in IDENTITIES]


def merged_streams(pages: DataFrame) -> DataFrame:
    """(key, host, stream, lo0, hi0, ...) for each distinct stream of a host, from (__host, __html); written once."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in slices(batch, "__html", 32_000_000, 1 << 20):
                found: dict[tuple, list] = {}
                for host, page in zip(piece.column("__host").to_pylist(), piece.column("__html").to_pylist(), strict=True):
                    page = blocks(page)
                    own = identities(page)
                    low, high = found.setdefault((host, stream(page)), [own, own])
                    found[host, stream(page)] = [list(map(min, low, own)), list(map(max, high, own))]
                cols = [[key_of(*k) for k in found], [k[0] for k in found], [k[1] for k in found]]
                ends = [pa.array([v[e][i] for v in found.values()], pa.int32()) for i in range(3) for e in range(2)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), *map(pa.array, cols[1:], [pa.string()] * 2), *ends], names=["key", "host", "stream", *IDENTITIES])

    parts = pages.select("__host", "__html").mapInArrow(run, "key binary, host string, stream string, " + ", ".join(f"{c} int" for c in IDENTITIES))
    return written(parts.groupBy("key").agg(F.first("host").alias("host"), F.first("stream").alias("stream"), *merged()), "page-streams")


def covered(streams: DataFrame) -> DataFrame:
    """(key, places): where windows of each stream start that repeat across distinct pages of its host; written once."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in slices(batch, "stream", 4_000_000, 1 << 16):
                name, which, place = names(piece.column("stream").to_pylist(), piece.column("host").to_pylist())
                rows = pa.array(which)
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(place.astype(np.int32)), *[piece.column(c).take(rows) for c in ("key", *IDENTITIES)]], names=["name", "place", "key", *IDENTITIES])

    suffixes = streams.mapInArrow(run, "name bigint, place int, key binary, " + ", ".join(f"{c} int" for c in IDENTITIES))
    differ = sum((F.col(f"lo{i}") != F.col(f"hi{i}")).cast("int") for i in range(3))
    repeated = suffixes.groupBy("name").agg(*merged()).filter(differ >= 2).select("name")
    places = suffixes.select("name", "place", "key").join(repeated, "name", "left_semi")
    return written(places.groupBy("key").agg(F.sort_array(F.collect_list("place")).alias("places")), "page-repeats")


def mask(places, size: int) -> np.ndarray:
    """Which of ``size`` tokens the windows at ``places`` cover."""
    ends = np.zeros(size + 1, dtype=np.int64)
    at = np.asarray(places if places is not None else [], dtype=np.int64)
    np.add.at(ends, at, 1)
    np.add.at(ends, np.minimum(at + LONG, size), -1)
    return np.cumsum(ends[:-1]) > 0


def main_text(kinds: str, texts: list[str], sizes: list[int], total: int, places) -> tuple[str, int, int]:
    """Text of a page, words that repeats removed, and words that only the markup removed."""
    if not places and OPEN not in kinds:
        return " ".join(t for t in texts if t), 0, sum(n - 1 for n in sizes if n)
    gone, at, out, repeated, marked, inside = mask(places, total), ENDS, [], 0, 0, False
    for kind, text, size in zip(kinds, texts, sizes, strict=True):
        if kind == ARTICLE:
            at += not inside
            inside = True
            out.append(text)
            continue
        inside = False
        own = gone[at + 1 : at + size]
        at += size
        repeated += int(own.sum())
        if kind == OPEN:
            out += [w for w, g in zip(text.split(" "), own, strict=True) if not g]
        else:
            marked += int((~own).sum())
    return " ".join(out), repeated, marked


def extract(pages: DataFrame, url_col: str, html_col: str, carry: list[str]) -> DataFrame:
    """``carry`` columns, text, n_chars, n_repeated, n_marked of every page.

    Null or empty pages, and pages without text outside markup, give an empty text.  A url that names no
    host (or null) belongs to the host "".  Repeated rows are extracted alike and count as one page, as do
    copies of a page.  ``n_repeated`` counts words that the suffix array covers, ``n_marked`` those that
    only their markup removed.  An empty table gives an empty result.
    """
    names_of = {c: f"__c{i}" for i, c in enumerate(carry)}
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1))
    plain = pages.select(*[F.col(c).alias(n) for c, n in names_of.items()], host.alias("__host"), F.col(html_col).alias("__html"))
    streams = merged_streams(plain)
    repeats = covered(streams)
    dropped(streams)
    own = [f"{n} {plain.schema[n].dataType.simpleString()}" for n in names_of.values()]

    def parsed(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in slices(batch, "__html", 16_000_000, 1 << 16):
                cols = {"key": [], "kinds": [], "texts": [], "sizes": [], "total": []}
                for host, page in zip(piece.column("__host").to_pylist(), piece.column("__html").to_pylist(), strict=True):
                    page = blocks(page)
                    text = stream(page)
                    cols["key"].append(key_of(host, text))
                    cols["kinds"].append("".join(b.kind for b in page))
                    cols["texts"].append([b.text if b.kind != AROUND else "" for b in page])
                    cols["sizes"].append([0 if b.kind == ARTICLE else b.text.count(" ") + 2 for b in page])
                    cols["total"].append(text.count("\n") + 1)
                kinds = [pa.binary(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32()]
                yield pa.RecordBatch.from_arrays([*[piece.column(n) for n in names_of.values()], *map(pa.array, cols.values(), kinds)], names=[*names_of.values(), *cols])

    def assembled(batches):
        import pyarrow as pa

        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("kinds", "texts", "sizes", "total", "places")], strict=True)
            text, repeated, marked = zip(*[main_text(*r) for r in rows], strict=True) if batch.num_rows else ((), (), ())
            cols = [pa.array(text, pa.string()), pa.array(repeated, pa.int64()), pa.array(marked, pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names_of.values()], *cols], names=[*names_of.values(), "__text", "__repeated", "__marked"])

    page = plain.mapInArrow(parsed, ", ".join([*own, "key binary, kinds string, texts array<string>, sizes array<int>, total int"]))
    out = page.join(repeats, "key", "left").mapInArrow(assembled, ", ".join([*own, "__text string, __repeated bigint, __marked bigint"]))
    return out.select(*[F.col(n).alias(c) for c, n in names_of.items()], F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"), F.col("__repeated").alias("n_repeated"), F.col("__marked").alias("n_marked"))
