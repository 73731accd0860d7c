"""Scalar rules over names and relations, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores before them where columns, in any case, has them."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def truthy(c: Column) -> Column:
    """Not null and not empty."""
    return F.nullif(c, F.lit("")).isNotNull()


def normalize(c: Column) -> Column:
    """Names compare without spaces, and with one sign for middle dots and commas."""
    return F.translate(F.replace(F.trim(c), F.lit(" "), F.lit("")), "·,", "ㆍㆍ")


def extract_root(c: Column) -> Column:
    """The lemma without the first matching verbal ending; an ending alone stays."""
    return F.regexp_replace(c, f"^(.+?)({'|'.join(vocab.ROOT_SUFFIXES)})$", "$1")


def strip_junk(c: Column) -> Column:
    """A canonical name with a known filler glued before it loses the filler."""
    glued = F.create_map(*(F.lit(x) for p in vocab.JUNK_PREFIXES for t in vocab.CANONICAL for x in (p + t, t)))
    return F.coalesce(F.try_element_at(glued, c), c)


def resolve_alias(c: Column) -> Column:
    aliases = F.create_map(*(F.lit(x) for kv in vocab.ALIASES.items() for x in kv))
    bare = strip_junk(c)
    return F.coalesce(F.try_element_at(aliases, bare), bare)


def is_law(c: Column) -> Column:
    """Ends like a legal instrument, is longer than the ending, and isn't one of the words that only look so."""
    ends = reduce(Column.__or__, (F.endswith(c, F.lit(s)) & (F.length(c) > len(s)) for s in vocab.LAW_SUFFIXES))
    return ~c.isin(*vocab.NOT_LAWS) & ends


def suffix_index(groups: tuple[tuple[str, list[str]], ...]) -> dict[str, tuple[str, str]]:
    """From each suffix to the (label, suffix) that a name ending in it gets.

    A name's longest suffix of all tells which others it has: those that the longest one ends in itself. So
    the first of them in the order of the rules is known beforehand.
    """
    rules = [(label, s) for label, group in groups for s in group]
    return {s: next((label, t) for label, t in rules if s.endswith(t)) for _, s in rules}


def entity_type(c: Column) -> Column:
    """struct(label, subtype, method) by suffix: law, person, organisation, concept; null without a match.

    One lookup in a hashed set for each length that suffixes have, longest first.
    """
    index = suffix_index((("Person", vocab.PERSON_SUFFIXES), ("Organization", vocab.ORG_SUFFIXES), ("Concept", vocab.CONCEPT_SUFFIXES)))
    kind = lambda label, subtype: F.struct(F.lit(label).alias("label"), subtype.alias("subtype"), F.lit("dict").alias("method"))
    found = F.when(is_law(c), kind("LegalDocument", F.lit("법령")))
    for n in sorted({len(s) for s in index}, reverse=True):
        end = F.right(c, F.lit(n))
        for s, (label, first) in index.items():
            if len(s) == n and first != s:  # a shorter suffix comes before it in the rules
                found = found.when(end == s, kind(label, F.lit(first)))
        for label in dict.fromkeys(label for label, _ in index.values()):
            own = [s for s, (to, first) in index.items() if len(s) == n and to == label and first == s]
            if own:
                found = found.when(end.isin(*own), kind(label, end))
    return found


def default_type() -> Column:
    """The type of a mention that neither the rules nor a classifier know."""
    return F.struct(F.lit("Concept").alias("label"), F.lit(None).cast("string").alias("subtype"), F.lit("llm_fallback_default").alias("method"))


def typed(c: Column) -> Column:
    """entity_type of the name that the mention resolves to, or the default of an unanswered classifier."""
    return F.coalesce(resolved_type(c), default_type())


def resolved_type(c: Column) -> Column:
    """entity_type of the resolved name, which is worked out once a row, however often the rules look at it."""
    return F.get(F.transform(F.array(resolve_alias(c)), entity_type), F.lit(0))


def subtype(*columns: Column) -> Column:
    """The first of the label's own columns that isn't empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def date_text(c: Column) -> Column:
    """A date as text: ISO where it is one, else as it stands; null for an empty one."""
    text = F.nullif(F.trim(c.cast("string")), F.lit(""))
    return F.coalesce(F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd"), text)


#: How much of the evidence a classifier is shown.
SHOWN = 200


def clause_text(agent: Column, verb: Column, patient: Column, evidence: Column, index: Column | None = None) -> Column:
    """A clause as a classifier is asked about it, with its number in the batch if it has one; missing ends are marked as left out."""
    end = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("(생략)"))
    number = [F.lit("["), index.cast("string"), F.lit("] ")] if index is not None else []
    return F.concat(*number, F.lit("주어="), end(agent), F.lit(" / 동사="), verb, F.lit(" / 목적어="), end(patient), F.lit(" / 원문: "), F.substring(F.coalesce(evidence, F.lit("")), 1, SHOWN))


def article_label(number: Column, sub: Column) -> Column:
    return F.concat(F.lit("제"), number.cast("string"), F.lit("조"), F.when(F.coalesce(sub, F.lit(0)) != 0, F.concat(F.lit("의"), sub.cast("string"))).otherwise(""))


def place(law: Column, article: Column, paragraph: Column) -> Column:
    """Law, article and, if it has one, paragraph."""
    text = lambda x: F.coalesce(x.cast("string"), F.lit("None"))
    return F.concat(text(law), F.lit(" 제"), text(article), F.lit("조"), F.when(F.coalesce(paragraph, F.lit(0)) != 0, F.concat(F.lit(" 제"), paragraph.cast("string"), F.lit("항"))).otherwise(""))


def entity_description(name: Column, label: Column, subtype: Column) -> Column:
    return F.concat(name, F.lit(" ("), label, F.when(truthy(subtype), F.concat(F.lit(": "), subtype)).otherwise(""), F.lit(")"))


def _link(source: Column, edge_type: Column, target: Column, modality: Column, voice: Column) -> Column:
    text = lambda x: F.coalesce(x, F.lit("None"))
    return F.concat(source, F.lit(" -["), edge_type, F.lit("]-> "), target, F.lit(" (modality="), text(modality), F.lit(", voice="), text(voice), F.lit(")"))


def relation_description(law, article, paragraph, source, edge_type, target, modality, voice) -> Column:
    return F.concat(place(law, article, paragraph), F.lit(": "), _link(source, edge_type, target, modality, voice))


def context_line(law, article, paragraph, source, edge_type, target, modality, voice) -> Column:
    return F.concat(F.lit("["), place(law, article, paragraph), F.lit("] "), _link(source, edge_type, target, modality, voice))


def plain_line(label_a: Column, a: Column, edge_type: Column, label_b: Column, b: Column) -> Column:
    return F.concat(F.lit("("), label_a, F.lit(") "), a, F.lit(" -["), edge_type, F.lit("]-> ("), label_b, F.lit(") "), b)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two float arrays, in doubles; null if a norm is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def stable_id(*parts: Column) -> Column:
    """The same id for the same parts, on every run."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)), 256)
