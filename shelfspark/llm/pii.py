"""Personal data: fixed patterns, and terms that give protected values away.

Patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers.
Each value found is a protected entity.  Corpus statistics then say how much a
term reveals of an entity: with document counts over the whole corpus,

    PMI(a; t) = log2( n(a, t) N / (n(a) n(t)) ),   IC(a) = log2( N / n(a) )

where n(a, t) counts the documents that hold ``a`` and, anywhere outside of
protected values, ``t``.  A term with PMI >= ``generalise`` x IC discloses the
entity and is generalised to a category word, from ``remove`` x IC on it is
removed, in every document that holds the entity.  A single meeting proves
nothing (a word of one document has PMI = IC with all that the document holds):
a term needs ``support`` different texts with the entity.  Texts are told apart
by their smallest shingle hash, so copies count once, and so do most near copies.

Defined results: null or empty text: no spans; empty table: empty result;
repeated rows: one row each; a null doc_id gets pattern spans only; further
columns are ignored (``sanitise`` keeps them)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, fresh, text_chunks

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    # a run of digits is tried from its start only: from within it ends the same way
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
PLACEHOLDERS = {k: f"[{k.upper()}]" for k in KINDS} | {"general": "[TERM]", "remove": ""}
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"  # of an address, before the @
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]\.[0-9]++\.[0-9]")  # cheap to look for; without one there is no ip
_DIGITS = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_SHINGLE = 3

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for at, ch in enumerate(reversed(digits)):
        n = int(ch) * (1 + at % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _holds(kind: str, value: str) -> bool:
    if kind == "ip":
        parts = [p.lstrip("0") or "0" for p in value.split(".")]
        return all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        digits = _DIGITS.sub("", value)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_DIGITS.sub("", value)) <= 15
    return True


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[local]+@domain`` from left to right.  Found from each @ outwards, so
    that a long run without one costs no more than its length."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        low = m.end() if m else at + 1
        at = text.find("@", low)


def base_spans(text: str) -> list[Span]:
    """Pattern spans by kind as listed, then start; leftmost and non-overlapping
    within a kind; a match that fails its check is dropped, not retried.  Linear in
    the text."""
    out: list[Span] = [("email", *span) for span in emails(text)]
    for kind in KINDS[1:]:
        if kind == "phone" and "+" not in text or kind == "ip" and not _DOTTED.search(text):
            continue
        out += [(kind, m.start(), m.end()) for m in PATTERNS[kind].finditer(text) if _holds(kind, m.group())]
    return out


def term_spans(text: str, terms: dict[str, str], base: list[Span]) -> list[Span]:
    """Every word of ``text`` that is a key of ``terms``, outside the base spans,
    as (action, start, end)."""
    if not terms:
        return []
    taken = sorted((a, b) for _, a, b in base)
    found, at = [], 0
    for m in _WORD.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        action = terms.get(m.group().lower())
        if action and not any(a < m.end() and m.start() < b for a, b in taken[at:at + 4]):
            found.append((action, m.start(), m.end()))
    return sorted(found)


def words_outside(text: str, base: list[Span]) -> list[str]:
    """The words of ``text`` outside the base spans, as written."""
    out, at = [], 0
    for start, end in sorted((a, b) for _, a, b in base):
        out += _WORD.findall(text, at, max(at, start))
        at = max(at, end)
    return out + _WORD.findall(text, at)


def context(words: list[str]) -> int:
    """Smallest hash of the word shingles: equal for copies, mostly for near copies."""
    low = " ".join(words).lower().encode().split(b" ")
    grams = zip(*(low[i:] for i in range(min(_SHINGLE, len(low)))))
    return min(map(xxhash.xxh64_intdigest, map(b" ".join, grams))) >> 1


WANTED_BYTES = 16 << 20


def _own_terms(text: str) -> set[str]:
    """The distinct words of a text, outside of protected values."""
    return {w.lower() for w in set(words_outside(text, base_spans(text)))}


def term_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n_term): how many documents hold each term of ``wanted`` outside of
    protected values.  A list of terms below ``WANTED_BYTES`` travels to the texts,
    each task hands on one row for a term; a longer one meets all words of all texts."""
    small = (wanted.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0) <= WANTED_BYTES
    names = docs.sparkSession.sparkContext.broadcast(frozenset(r["term"] for r in wanted.collect()) if small else None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in text_chunks(batches):
            for text in batch.column("text").to_pylist():
                if text and not names.value.isdisjoint({w.lower() for w in set(_WORD.findall(text))}):
                    found.update(_own_terms(text) & names.value)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            found = [list(_own_terms(t)) if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["terms"])

    texts = docs.select("text")
    if small:
        return texts.mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    return (texts.mapInArrow(every, "terms array<string>").select(F.explode("terms").alias("term")).join(wanted, "term")
            .groupBy("term").agg(F.count("*").alias("n_term")))


def contexts(docs: DataFrame) -> DataFrame:
    """(doc_id, context, entities, terms): a row for each document with protected values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                base = base_spans(text or "")
                if base:
                    words = words_outside(text, base)
                    rows.append((doc, context(words), sorted({text[a:b] for _, a, b in base}), sorted({w.lower() for w in set(words)})))
            if rows:
                cols = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["doc_id", "context", "entities", "terms"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, context long, entities array<string>, terms array<string>")


def disclosing_terms(docs: DataFrame, support: int = 3, generalise: float = 0.9, remove: float = 0.97) -> DataFrame | None:
    """(doc_id, terms): for each document that holds an entity, the terms that
    disclose it, mapped to ``general`` or ``remove``.  None if there are none."""
    seen = cut(contexts(docs), "pii-contexts")
    total = F.lit(float(docs.count()))
    told = F.log2(total / F.col("n_entity"))
    holding = seen.select("doc_id", "context", F.explode("entities").alias("entity"))
    # an entity of fewer texts than ``support`` has no term of so many
    entities = (holding.groupBy("entity", "context").agg(F.count("*").alias("n"))
                .groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("texts"))
                .where((F.col("texts") >= support) & (told > 0)).select("entity", "n_entity"))
    entities = cut(entities, "pii-entities")
    near = (seen.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_near"))
            .where(F.col("n_near") >= support))

    def pmi(n_both: str, n_term: str) -> Column:
        return F.log2(F.col(n_both) * total / (F.col("n_entity") * F.col(n_term)))

    # a term is in at least as many documents as those with any entity, and meets an
    # entity in at most the entity's, so both cuts leave out only terms that cannot
    # pass (frequent words), before pairs and before the corpus are counted
    met = (seen.select("context", F.explode("entities").alias("entity"), "terms").join(entities, "entity")
           .select("entity", "n_entity", "context", F.explode("terms").alias("term")).join(near, "term")
           .where(pmi("n_entity", "n_near") >= generalise * told - 1e-9))
    likely = (met.groupBy("entity", "term", "context", "n_entity", "n_near").agg(F.count("*").alias("n"))
              .groupBy("entity", "term", "n_entity", "n_near").agg(F.sum("n").alias("n_both"), F.count("*").alias("texts"))
              .where((F.col("texts") >= support) & (pmi("n_both", "n_near") >= generalise * told))
              .select("entity", "term", "n_both", "n_entity"))
    likely = cut(likely, "pii-candidates")
    if likely.isEmpty():
        return None
    wanted = cut(likely.select("term").distinct(), "pii-terms")
    found = (likely.join(term_counts(docs, wanted), "term").where(pmi("n_both", "n_term") >= generalise * told)
             .select("entity", "term", F.when(pmi("n_both", "n_term") >= remove * told, "remove").otherwise("general").alias("action")))
    by_doc = (holding.where("doc_id is not null").select("entity", "doc_id").distinct().join(found, "entity")
              .groupBy("doc_id", "term").agg(F.max("action").alias("action"))
              .groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("terms")))
    by_doc = cut(by_doc, "pii-disclosed")
    return None if by_doc.isEmpty() else by_doc


def _with_terms(docs: DataFrame, found: DataFrame | None, name: str) -> DataFrame:
    if found is None:
        return docs.withColumn(name, F.lit(None).cast("map<string,string>"))
    # a file of known size: broadcast only if small
    return docs.join(found.withColumnRenamed("terms", name), "doc_id", "left")


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, **thresholds) -> DataFrame:
    """One row per document: doc_id, n_<kind>, base_sha256, spans, n_term."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            out: list[list] = [[] for _ in range(len(KINDS) + 3)]
            for text, terms in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist()):
                base = base_spans(text or "")
                more = term_spans(text or "", dict(terms or {}), base)
                for at, kind in enumerate(KINDS):
                    out[at].append(sum(s[0] == kind for s in base))
                out[-3].append(hashlib.sha256(_written(base).encode()).hexdigest())
                out[-2].append(_written(base + more))
                out[-1].append(len(more))
            types = [*[pa.int64()] * len(KINDS), pa.string(), pa.string(), pa.int64()]
            names = [*[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_term"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, types)]],
                                             names=["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_term long"
    return _with_terms(rows, disclosing_terms(rows, **thresholds), "terms").mapInArrow(run, schema)


def sanitised(text: str, terms: dict[str, str]) -> str:
    """The text with its spans replaced by placeholders; of overlapping spans the
    first start (then the longest) is replaced, up to the furthest end."""
    base = base_spans(text)
    spans = sorted(((a, -b, k) for k, a, b in base + term_spans(text, terms, base)))
    out, at = [], 0
    for start, end, kind in spans:
        if start < at:
            at = max(at, -end)
            continue
        out += [text[at:start], PLACEHOLDERS[kind]]
        at = -end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """``docs`` with every text sanitised; a null text stays null, all columns stay."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names, terms = docs.columns, fresh(docs, "terms")
    both = _with_terms(docs, disclosing_terms(rows, **thresholds), terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            texts = [None if t is None else sanitised(t, dict(m or {}))
                     for t, m in zip(batch.column("text").to_pylist(), batch.column(terms).to_pylist())]
            cols = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return both.select(*names, terms).mapInArrow(run, docs.schema)
