"""Information-theoretic sanitisation of personal data.

Protected entities are what the base patterns find: e-mail and IP addresses,
card and phone numbers. A term near an entity may reveal it too. How strongly
is estimated over the whole corpus: with c(e) occurrences of the entity, c(t)
of the term, c(e,t) of the term within ``window`` words of the entity, and N
words in all,

    PMI(e;t) = log2(c(e,t) N / (c(e) c(t))),  disclosure = PMI(e;t) / -log2(c(e)/N)

is the share of the entity's information that the term gives away. Terms seen
with the entity at least ``support`` times are generalised from one threshold
on and removed from a higher one, wherever they stand in a text that holds that
entity, be it near or far. A pair seen less often is no evidence: its terms stay.

An entity that the corpus holds less than ``support`` times can have no such
pair. It backs off to the group it belongs to (the domain of an address, the
first three parts of an IP address, the issuer's six digits of a card, the
first three digits of a phone number), and where that is as rare, to its kind;
counts of a group are those of all its members, and a term near several members
counts once. So what tells of a rare entity is judged by what tells of its like.

Null text is empty. Offsets are code points, ends exclusive. Repeated rows are
rows of their own and count as often as they occur; a null id stays null. An
empty table has no rows. Other columns are not read, so names cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import small_enough, written

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")
_RANK = {k: i for i, k in enumerate((*KINDS, *TERM_KINDS))}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match cannot start inside a run of digits whose start fails, so a run is tried once
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def _emails(text: str):
    """Leftmost matches; each @ is tried once with the local part before it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, canonical value), sorted by start, then kind."""
    out = [(s, "email", e, text[s:e].lower()) for s, e in _emails(text)]
    if _HAS_DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append((m.start(), "ip", m.end(), ".".join(parts)))
        for m in _CARD.finditer(text):
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), "card", m.end(), d))
        if "+" in text:
            for m in _PHONE.finditer(text):
                d = _digits(m.group())
                if 9 <= len(d) <= 15:
                    out.append((m.start(), "phone", m.end(), d))
    return sorted(out, key=lambda x: (x[0], _RANK[x[1]], x[2]))


_HAS_DIGIT = re.compile("[0-9]")


def _words(text: str, found):
    """(start, end) of every word, and whether it lies in an entity."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = [w[0] for w in words]
    inside = [False] * len(words)
    for s, _, e, _ in found:
        i = max(0, bisect_left(starts, s) - 1)
        while i < len(words) and words[i][0] < e:
            inside[i] |= words[i][1] > s
            i += 1
    return words, inside


def levels(kind: str, value: str) -> tuple[str, str, str]:
    """An entity, the group it backs off to, and its kind."""
    group = {"email": lambda: value.rsplit("@", 1)[-1], "ip": lambda: value.rsplit(".", 1)[0],
             "card": lambda: value[:6], "phone": lambda: value[:3]}[kind]()
    return f"{kind}:{value}", f"{kind}~{group}", kind


def _contexts(text: str, found, window: int):
    """(entity, lower-cased term, start, end) of the words near each entity, at
    every level of it."""
    words, inside = _words(text, found)
    starts = [w[0] for w in words]
    for s, kind, e, value in found:
        after, names = bisect_left(starts, s), levels(kind, value)
        for step, i in ((-1, after - 1), (1, after)):
            left = window
            while 0 <= i < len(words) and left:
                if not inside[i]:
                    a, b = words[i]
                    term = text[a:b].lower()
                    for name in names:
                        yield name, term, a, b
                    left -= 1
                i += step


def _hashes(strings: list[str]) -> np.ndarray:
    raw = [s.encode() for s in strings]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    return T.span_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), starts, ends).view(np.int64)


_FOUND = ("rid long, doc_id long, base array<struct<start:int, kind:string, end:int>>, "
          "near array<struct<entity:long, term:long, start:int, end:int>>, own array<array<long>>, text string, "
          "text_sha256 string")
_BASE = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
_NEAR = pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def find_base(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: a row id, its base spans, the terms near them, its entities with
    their levels and, if it has any, its text; the hash of every text."""
    def found(batches):
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            base, near, own, texts, hashes = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text or "")
                base.append([{"start": s, "kind": k, "end": e} for s, k, e, _ in spans])
                own.append([levels(k, v) for _, k, _, v in spans])
                near.append(list(dict.fromkeys(_contexts(text, spans, window))) if spans else [])
                texts.append(text if spans else None)
                hashes.append(sha256((text or "").encode()).hexdigest())
            terms, entities = [x[1] for n in near for x in n], [x[0] for n in near for x in n]
            th = iter(_hashes(terms).tolist() if terms else ())
            eh = iter(_hashes(entities).tolist() if entities else ())
            oh = iter(_hashes([x for o in own for names in o for x in names]).tolist() if any(own) else ())
            near = [[{"entity": next(eh), "term": next(th), "start": a, "end": b} for _, _, a, b in n] for n in near]
            own = [[[next(oh) for _ in names] for names in o] for o in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(rid, rid + len(base)), pa.int64()), batch.column(0), pa.array(base, pa.list_(_BASE)),
                 pa.array(near, pa.list_(_NEAR)), pa.array(own, pa.list_(pa.list_(pa.int64()))),
                 pa.array(texts, pa.string()), pa.array(hashes, pa.string())],
                names=["rid", "doc_id", "base", "near", "own", "text", "text_sha256"])
            rid += len(base)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        found, _FOUND)


_AT = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def places(rows: DataFrame, held: int = 1 << 16) -> DataFrame:
    """(rid, term, at) of ``rows`` (rid, text): where each term stands outside
    the entities, a row per term and text; ``held`` rows or a text's make a batch."""
    def found(batches):
        rids, terms, at = [], [], []

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(_hashes(terms)),
                                              pa.array(at, pa.list_(_AT))], names=["rid", "term", "at"])
            for held_rows in (rids, terms, at):
                held_rows.clear()
            return got

        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own: dict[str, list[dict]] = {}
                words, inside = _words(text, base_spans(text))
                for (s, e), skip in zip(words, inside):
                    if not skip:
                        own.setdefault(text[s:e].lower(), []).append({"start": s, "end": e})
                rids += [rid] * len(own)
                terms += own
                at += own.values()
                if len(rids) >= held:
                    yield out()
        if rids:
            yield out()

    return rows.select("rid", "text").mapInArrow(found, "rid long, term long, at array<struct<start:int, end:int>>")


def term_totals(docs: DataFrame, text_col: str = "text", held: int = 1 << 21) -> DataFrame:
    """Occurrences of every term of the corpus, by hash; ``held`` bounds what a
    task keeps before it passes its sums on."""
    def counted(batches):
        keys = np.zeros(0, np.uint64)
        sums = np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def merge():
            nonlocal keys, sums, waiting, size
            every = np.concatenate([keys, *waiting])
            weight = np.concatenate([sums, np.ones(len(every) - len(keys), np.int64)])
            keys, where = np.unique(every, return_inverse=True)
            sums = np.bincount(where, weights=weight, minlength=len(keys)).astype(np.int64)
            waiting, size = [], 0

        def out():
            nonlocal keys, sums
            got = pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)], names=["term", "n"])
            keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return got

        for batch in batches:
            for _, data, offsets in T.runs(batch.column(0), lower=True):
                hashes = T.word_hashes(data, offsets)[0]
                waiting.append(hashes)
                size += len(hashes)
                if size > held:
                    merge()
                    if len(keys) > held:
                        yield out()
        merge()
        yield out()

    return docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).mapInArrow(
        counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("term_n"))


def by_frequency(own: DataFrame, entities: DataFrame) -> DataFrame:
    """(rid, entity) of ``own`` (rid, at, names): for each entity its first level
    that is in ``entities``."""
    named = own.select("rid", "at", F.posexplode("names").alias("level", "entity"))
    few = F.broadcast(entities) if small_enough(entities) else entities
    return named.join(few, "entity", "left_semi").groupBy("rid", "at").agg(
        F.min_by("entity", "level").alias("entity")).select("rid", "entity").distinct()


_TERMS = "array<struct<start:int, kind:string, end:int, disclosure:double>>"


def find(docs: DataFrame, window: int = 8, support: int = 3, generalise: float = 0.8, remove: float = 0.95,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: rid, doc_id, base spans, term spans with their disclosure, the
    hash of the text, and the sanitised text (null if the text stays as it is)."""
    found = written(find_base(docs, window, id_col, text_col), "pii-base")
    some = found.where(F.size("own") > 0)
    near = some.select("rid", F.explode("near").alias("x")).select("rid", "x.*")
    pairs = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    entities = some.select(F.explode(F.flatten("own")).alias("entity")).groupBy("entity").agg(
        F.count(F.lit(1)).alias("entity_n")).where(F.col("entity_n") >= support)
    entities = written(entities, "pii-entities")
    few = F.broadcast(entities) if small_enough(entities) else entities
    totals = written(term_totals(docs, text_col), "pii-terms")
    words = totals.agg(F.sum("term_n")).first()[0] or 1
    p = F.col("entity_n") / F.lit(float(words))
    pmi = F.log2(F.col("n") / F.col("term_n") / p)
    told = pairs.join(few, "entity").join(totals, "term").select(
        "entity", "term", F.when(p < 1, pmi / -F.log2(p)).alias("disclosure")).where(F.col("disclosure") >= generalise)
    told = written(told, "pii-disclosed")
    # a term is told of few entities, an entity by many terms and in many texts: join by term, then by text
    own = by_frequency(some.select("rid", F.posexplode("own").alias("at", "names")), entities.select("entity"))
    by_term = F.broadcast(told) if small_enough(told) else told
    terms = (places(some).join(by_term, "term").join(own, ["rid", "entity"], "left_semi")
             .groupBy("rid", "term").agg(F.first("at").alias("at"), F.max("disclosure").alias("disclosure"))
             .select("rid", "disclosure", F.inline("at"))
             .groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(
                 "start", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise").alias("kind"),
                 "end", "disclosure"))).cast(_TERMS).alias("terms")))
    return sanitised(found.select("rid", "doc_id", "base", "text_sha256", "text").join(terms, "rid", "left"))


def sanitised(rows: DataFrame) -> DataFrame:
    """``rows`` with their text replaced by its sanitised form, null for null."""
    def cleaned(batches):
        for batch in batches:
            held = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            texts = [text if text is None else sanitise(text, [(x["start"], x["kind"], x["end"])
                                                               for x in (*base, *(terms or ()))])
                     for text, base, terms in zip(*(held[n].to_pylist() for n in ("text", "base", "terms")))]
            held["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(held.values()), names=list(held))

    rows = rows.select("rid", "doc_id", "base", "text_sha256", "text", "terms")
    return rows.mapInArrow(cleaned, rows.schema).withColumnRenamed("text", "sanitised")


def _joined(spans) -> "F.Column":
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(findings: DataFrame) -> DataFrame:
    """The counts, the hash of the base spans, all spans of ``find`` and the hash
    of the sanitised text."""
    rank = F.create_map(*[F.lit(v) for k, i in _RANK.items() for v in (k, i)])
    plain = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: F.struct(
        x["start"].alias("start"), F.element_at(rank, x["kind"]).alias("rank"), x["kind"].alias("kind"),
        x["end"].alias("end")))
    every = F.array_sort(F.concat(plain(F.col("base")), plain(F.col("terms"))))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return findings.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                           F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"),
                           F.coalesce(F.sha2("sanitised", 256), "text_sha256").alias("sanitised_sha256"))


def sanitise(text: str, spans: list[tuple[int, str, int]]) -> str:
    """A text with its base spans masked and its terms generalised or removed;
    of overlapping spans the first, then the longest, counts."""
    out, at = [], 0
    for start, kind, end in sorted(spans, key=lambda x: (x[0], -x[2])):
        if start < at:
            continue
        term = text[start:end]
        out += [text[at:start], "" if kind == "remove" else f"[{kind.upper()}]" if kind in KINDS
                else "[NUMBER]" if term.isdigit() else "[NAME]" if term[:1].isupper() else "[TERM]"]
        at = end
    return "".join((*out, text[at:]))
