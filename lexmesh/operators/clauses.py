"""Agent, verb and patient of clauses, from tagged tokens.

Input rows are (unit, tokens array<struct<form, tag>>), `unit` being columns that name a unit of text.
`extract` is a state machine over the array of a unit's tokens, sentence by sentence: registers hold the last subject,
topic, object and by-phrase, and a verb takes a copy of them. Tokens are never exploded or shuffled. The carry of a
subject from unit to unit is a window over the units of an article, for what a unit observes of its own doesn't
depend on what it inherits. `fold` is the same by one pass in Python, per article.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import extract_root
from ..functions.vocab import MODAL_STEMS, NP_TAGS
from .ordering import carried

# Tags and forms of the rules.
VERBAL, PREDICATE, ENDS, PASSIVE = ("XSV", "XSA"), ("VV", "VA"), ("EF", "SF"), ("되", "받")
TOPIC_FORMS = ("은", "는")
DISCRETION, PROHIBITION, DUTY, NO_MODALITY = "재량", "금지", "의무", "없음"
ACTIVE_VOICE, PASSIVE_VOICE = "능동", "피동"


Tokenizer = Callable[[str], list[tuple[str, str]]]


def tokenize(rows: DataFrame, make: Callable[[], Tokenizer], text: str = "unit_text") -> DataFrame:
    """rows with tokens, by a tokenizer that each worker makes once; words of a user's own are make's affair."""

    @F.pandas_udf("array<struct<form: string, tag: string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = make()
        for texts in batches:
            yield pd.Series([[{"form": f, "tag": t} for f, t in tokenizer(x or "")] for x in texts], dtype=object)

    return rows.withColumn("tokens", run(F.col(text)))


def tokens(rows: DataFrame, unit: Sequence[str]) -> DataFrame:
    """A row per token: unit, pos, form, tag, sentence, np (noun-phrase token), np_text (of the run that ends before it), verb_len."""
    t = rows.select(*unit, F.posexplode("tokens").alias("pos", "t")).select(*unit, "pos", "t.form", "t.tag")
    w = Window.partitionBy(*unit).orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ends, np = F.col("tag").isin(*ENDS), F.col("tag").isin(*NP_TAGS) | ((F.col("tag") == "NNB") & (F.col("form") == "등"))
    t = t.withColumns({"sentence": F.coalesce(F.sum(ends.cast("int")).over(before), F.lit(0)), "np": np, "next_tag": F.lead("tag").over(w), "next_form": F.lead("form").over(w), "prev_tag": F.lag("tag").over(w), "prev_form": F.lag("form").over(w)})
    # islands: tokens that aren't of a noun phrase count up, and a run shares their count
    t = t.withColumn("island", F.sum((~F.col("np")).cast("int")).over(w))
    run = Window.partitionBy(*unit, "island").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("run", F.array_join(F.collect_list(F.when(F.col("np"), F.col("form"))).over(run), ""))
    t = t.withColumn("np_text", F.nullif(F.when(F.lag("np").over(w), F.lag("run").over(w)), F.lit("")))
    compound = F.col("tag").isin(*NP_TAGS) & F.coalesce(F.col("next_tag").isin(*VERBAL), F.lit(False))
    bare = F.col("tag").isin(*PREDICATE) & ~F.col("form").isin(*MODAL_STEMS)
    return t.withColumn("verb_len", F.when(compound, 2).when(bare, 1))


def _sentences(tokens: Column) -> Column:
    """The tokens as an array of sentences, each with its place in the unit and its end token."""
    ends = F.filter(F.transform(tokens, lambda t, i: F.when(t["tag"].isin(*ENDS), i)), lambda i: i.isNotNull())
    # one more behind the last end, empty if nothing follows
    stops = F.array(F.concat(ends, F.array(F.size(tokens) - 1)))

    def cut(every: Column) -> Column:
        begin = lambda n: F.when(n > 0, F.get(every, n - 1) + 1).otherwise(0)
        return F.transform(every, lambda stop, n: F.struct(begin(n).alias("begin"), F.slice(tokens, begin(n) + 1, stop - begin(n) + 1).alias("tokens")))

    # worked out once, then looked at by every sentence
    return F.get(F.transform(stops, cut), F.lit(0))


def _registered(sentence: Column) -> Column:
    """A record for each verb phrase of a sentence, with what the registers hold before it: pos, len, lemma, voice, subj, topic, obj, by."""
    toks = sentence["tokens"]
    ahead = F.transform(toks, lambda t, i: F.struct(t["form"].alias("form"), t["tag"].alias("tag"), F.get(toks, i + 1)["form"].alias("next_form"), F.get(toks, i + 1)["tag"].alias("next_tag"), (sentence["begin"] + i).alias("pos")))
    text = F.lit(None).cast("string")
    record = "array<struct<pos: int, len: int, lemma: string, voice: string, subj: string, topic: string, obj: string, by: string>>"
    # np is the noun run before a token, before the one before the token ahead of it
    start = F.struct(F.lit("").alias("np"), F.lit("").alias("before"), text.alias("prev_form"), text.alias("prev_tag"), text.alias("subj"), text.alias("topic"), text.alias("obj"), text.alias("by"), F.array().cast(record).alias("out"))

    def step(s: Column, t: Column) -> Column:
        form, tag, phrase = t["form"], t["tag"], F.nullif(s["np"], F.lit(""))
        noun = tag.isin(*NP_TAGS) | ((tag == "NNB") & (form == "등"))
        subj, obj = (tag == "JKS") & phrase.isNotNull(), (tag == "JKO") & phrase.isNotNull()
        topic = (tag == "JX") & form.isin(*TOPIC_FORMS) & phrase.isNotNull()
        by = (tag == "VV") & (form == "의하") & F.coalesce((s["prev_tag"] == "JKB") & (s["prev_form"] == "에"), F.lit(False))
        compound = tag.isin(*NP_TAGS) & F.coalesce(t["next_tag"].isin(*VERBAL), F.lit(False))
        verb = compound | (tag.isin(*PREDICATE) & ~form.isin(*MODAL_STEMS))
        lemma = F.concat(form, F.when(compound, t["next_form"]).otherwise(""), F.lit("다"))
        voice = F.when(compound & t["next_form"].isin(*PASSIVE), PASSIVE_VOICE).otherwise(ACTIVE_VOICE)
        found = {"pos": t["pos"], "len": F.when(compound, 2).otherwise(1), "lemma": lemma, "voice": voice, "subj": s["subj"], "topic": s["topic"], "obj": s["obj"], "by": F.nullif(s["by"], F.lit(""))}
        now = {
            "np": F.when(noun, F.concat(s["np"], form)).otherwise(""), "before": s["np"], "prev_form": form, "prev_tag": tag,
            "subj": F.when(subj, phrase).otherwise(s["subj"]), "topic": F.when(topic, phrase).otherwise(s["topic"]), "obj": F.when(subj, text).when(obj, phrase).otherwise(s["obj"]), "by": F.when(by, s["before"]).otherwise(s["by"]),
            "out": F.when(verb, F.array_append(s["out"], F.struct(*(c.alias(k) for k, c in found.items())))).otherwise(s["out"]),
        }
        return F.struct(*(c.alias(k) for k, c in now.items()))

    return F.aggregate(ahead, start, step, lambda s: s["out"])


def _moods(sentence: Column) -> Column:
    """(at, level) of the patterns of modality in a sentence; the larger level decides."""
    toks = sentence["tokens"]

    def level(t: Column, i: Column) -> Column:
        pair = lambda form, tag, form2, tag2: (t["form"] == form) & (t["tag"] == tag) & F.get(toks, i + 1)["form"].isin(*form2) & (F.get(toks, i + 1)["tag"] == tag2)
        return F.when(pair("수", "NNB", ("있",), "VA"), 3).when(pair("지", "EC", ("아니하", "못하"), "VX"), 2).when(pair("어야", "EC", ("하",), "VX"), 1)

    return F.filter(F.transform(toks, lambda t, i: F.struct((sentence["begin"] + i).alias("at"), level(t, i).alias("level"))), lambda m: m["level"].isNotNull())


def records(tokens: Column) -> Column:
    """array<array<struct>>: of each sentence its verb phrases: pos, verb_lemma, voice, modality, subj, topic, obj, by_agent."""
    moods = F.array(*map(F.lit, (NO_MODALITY, DUTY, PROHIBITION, DISCRETION)))

    def of(sentence: Column) -> Column:
        # both are worked out once, then looked at by every record
        held = F.array(F.struct(_registered(sentence).alias("found"), _moods(sentence).alias("moods")))
        return F.get(F.transform(held, with_moods), F.lit(0))

    def with_moods(h: Column) -> Column:
        def one(r: Column, i: Column) -> Column:
            begin, stop = r["pos"] + r["len"], F.coalesce(F.get(h["found"], i + 1)["pos"], F.lit(1 << 30))
            own = F.array_max(F.transform(F.filter(h["moods"], lambda m: (m["at"] >= begin) & (m["at"] + 1 < stop)), lambda m: m["level"]))
            return F.struct(r["pos"].alias("pos"), r["lemma"].alias("verb_lemma"), r["voice"].alias("voice"), F.get(moods, F.coalesce(own, F.lit(0))).alias("modality"), r["subj"].alias("subj"), r["topic"].alias("topic"), r["obj"].alias("obj"), r["by"].alias("by_agent"))

        return F.transform(h["found"], one)

    return F.transform(_sentences(tokens), of)


def hands(found: Column) -> Column:
    """struct(agent) that a unit hands on: of its last record whose source is a subject or a topic, a null one too; null without one."""
    own = F.filter(F.flatten(found), lambda r: (r["subj"].isNotNull() | r["topic"].isNotNull()) & ((r["voice"] != PASSIVE_VOICE) | r["by_agent"].isNull()))
    agent = lambda r: F.struct(F.when(r["voice"] != PASSIVE_VOICE, F.coalesce(r["subj"], r["topic"])).alias("agent"))
    return F.get(F.transform(F.slice(F.reverse(own), 1, 1), agent), F.lit(0))


def assigned(found: Column, inherited: Column) -> Column:
    """array<struct>: records with sentence, agent, patient and agent_source; a unit's first sentence may take what is inherited."""

    def one(r: Column, n: Column) -> Column:
        usable = inherited.isNotNull() & (n == 0)
        active = F.coalesce(r["subj"], r["topic"], F.when(usable, inherited))
        source = F.when(r["subj"].isNotNull(), "JKS").when(r["topic"].isNotNull(), "TOPIC").when(usable, "INHERITED").otherwise("NONE")
        patient = F.when(r["subj"].isNotNull() & r["obj"].isNull(), r["topic"]).otherwise(r["obj"])
        passive = r["voice"] == PASSIVE_VOICE
        ends = {"agent": F.when(passive, r["by_agent"]).otherwise(active), "patient": F.when(passive, active).otherwise(patient), "agent_source": F.when(passive & r["by_agent"].isNotNull(), "JKB(의하여)").otherwise(source)}
        return F.struct(n.alias("sentence"), *(r[c].alias(c) for c in ("pos", "verb_lemma", "voice", "modality", "subj", "topic", "obj", "by_agent")), *(c.alias(k) for k, c in ends.items()))

    def filled(rows: Column) -> Column:
        """An agent that nothing names is the subject of the next verb of the sentence that has one."""

        def one(r: Column, i: Column) -> Column:
            later = F.get(F.filter(F.slice(rows, i + 2, F.size(rows)), lambda x: x["agent_source"] == "JKS"), F.lit(0))
            given = F.when(later.isNotNull(), r.withField("agent", later["agent"]).withField("agent_source", F.lit("JKS(순방향유추)"))).otherwise(r)
            return F.when(r["agent"].isNull() & (r["agent_source"] == "NONE"), given).otherwise(r)

        return F.transform(rows, one)

    return F.flatten(F.transform(found, lambda sentence, n: F.get(F.transform(F.array(F.transform(sentence, lambda r: one(r, n))), filled), F.lit(0))))


def extract(rows: DataFrame, article: Sequence[str], unit: str = "unit_ord") -> DataFrame:
    """A row per verb phrase of all units, with the subject that each inherits from the units of its article before it.

    A unit hands on the agent of its last record whose source is JKS or TOPIC, a null one too.
    """
    keys = [*article, unit]
    found = rows.select(*keys, records(F.col("tokens")).alias("found")).withColumn("hands", hands(F.col("found")))
    each = found.withColumn("inherited", carried(F.col("hands"), article, unit)["agent"]).select(*keys, F.explode(assigned(F.col("found"), F.col("inherited"))).alias("r")).select(*keys, "r.*")
    return each.withColumn("verb_root", extract_root(F.col("verb_lemma")))


def fold(rows: DataFrame, article: Sequence[str], unit: str = "unit_ord") -> DataFrame:
    """As extract, by a pass over the tokens of each article in order."""
    keys = [*article, unit]
    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema), "pos int, verb_lemma string, agent string, patient string, voice string, modality string, agent_source string"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, inherited = [], None
        for row in pdf.sort_values(unit, kind="stable").itertuples(index=False):
            named = [getattr(row, k) for k in keys]
            found = _unit([(t["form"], t["tag"]) for t in row.tokens], inherited)
            out += [[*named, *r] for r in found]
            inherited = next((r[2] for r in reversed(found) if r[6] in ("JKS", "TOPIC")), inherited)
        return pd.DataFrame(out, columns=[*keys, "pos", "verb_lemma", "agent", "patient", "voice", "modality", "agent_source"])

    return rows.select(*keys, "tokens").groupBy(*article).applyInPandas(run, kind)


def _unit(toks: list[tuple[str, str]], inherited: str | None) -> list[list]:
    noun = [tag in NP_TAGS or (form, tag) == ("등", "NNB") for form, tag in toks]
    verb = {}
    for i, (form, tag) in enumerate(toks):
        if tag in NP_TAGS and i + 1 < len(toks) and toks[i + 1][1] in VERBAL:
            verb[i] = (form + toks[i + 1][0] + "다", PASSIVE_VOICE if toks[i + 1][0] in PASSIVE else ACTIVE_VOICE, i + 2)
        elif tag in PREDICATE and form not in MODAL_STEMS:
            verb[i] = (form + "다", ACTIVE_VOICE, i + 1)

    def phrase(end: int) -> str | None:
        begin = end
        while begin and noun[begin - 1]:
            begin -= 1
        return "".join(f for f, _ in toks[begin:end]) or None

    def mood(begin: int) -> str:
        stop = next((k for k in range(begin, len(toks)) if k in verb or toks[k][1] in ENDS), len(toks))
        pairs = set(zip(toks[begin:stop], toks[begin + 1 : stop], strict=False))
        if (("수", "NNB"), ("있", "VA")) in pairs:
            return DISCRETION
        if {(("지", "EC"), ("아니하", "VX")), (("지", "EC"), ("못하", "VX"))} & pairs:
            return PROHIBITION
        return DUTY if (("어야", "EC"), ("하", "VX")) in pairs else NO_MODALITY

    out: list[list] = []
    state: dict[str, str | None] = {}
    sentence, of = 0, []
    for i, (form, tag) in enumerate(toks):
        slot = "subj" if tag == "JKS" else "topic" if tag == "JX" and form in TOPIC_FORMS else "obj" if tag == "JKO" else None
        if slot and phrase(i):
            state[slot] = phrase(i)
            if slot == "subj":
                state.pop("obj", None)
        elif i in verb:
            lemma, voice, end = verb[i]
            subj, topic, obj = state.get("subj"), state.get("topic"), state.get("obj")
            agent, source = (subj, "JKS") if subj else (topic, "TOPIC") if topic else (inherited, "INHERITED") if inherited and not sentence else (None, "NONE")
            patient = topic if subj and obj is None else obj
            if voice == PASSIVE_VOICE:
                by = next((k for k in range(i - 1, 0, -1) if toks[k] == ("의하", "VV") and toks[k - 1] == ("에", "JKB") or toks[k][1] in ENDS), None)
                name = phrase(by - 1) if by is not None and toks[by][1] == "VV" else None
                agent, patient, source = (name, agent, "JKB(의하여)") if name else (None, agent, source)
            out.append([i, lemma, agent, patient, voice, mood(end), source])
            of.append(sentence)
        elif tag in ENDS:
            state, sentence = {}, sentence + 1
    for k, r in enumerate(out):
        if r[2] is None and r[6] == "NONE":
            later = next((s for s, n in zip(out[k + 1 :], of[k + 1 :], strict=True) if n == of[k] and s[6] == "JKS"), None)
            if later:
                r[2], r[6] = later[2], "JKS(순방향유추)"
    return out


def relations(found: DataFrame) -> DataFrame:
    """Records with both an agent and a patient."""
    return found.filter("coalesce(agent, '') <> '' and coalesce(patient, '') <> ''")


def verb_phrases(rows: DataFrame, unit: Sequence[str]) -> DataFrame:
    """(unit, pos, lemma, head_form, head_tag, modal): for counting; nouns NNG, NNP and XR, modal stems apart."""
    w = Window.partitionBy(*unit).orderBy("pos")
    t = rows.select(*unit, F.posexplode("tokens").alias("pos", "t")).select(*unit, "pos", "t.form", "t.tag")
    t = t.withColumns({"next_tag": F.lead("tag").over(w), "next_form": F.lead("form").over(w)})
    compound = F.col("tag").isin("NNG", "NNP", "XR") & F.col("next_tag").isin(*VERBAL)
    bare = F.col("tag").isin(*PREDICATE)
    lemma = F.when(compound, F.concat("form", "next_form", F.lit("다"))).when(bare, F.concat("form", F.lit("다")))
    return t.filter(compound | bare).select(*unit, "pos", lemma.alias("lemma"), F.col("form").alias("head_form"), F.col("tag").alias("head_tag"), (bare & F.col("form").isin(*MODAL_STEMS)).alias("modal"))


def noun_runs(rows: DataFrame, unit: Sequence[str]) -> DataFrame:
    """(unit, start, noun, n, head_tag): runs of NNG and NNP."""
    t = rows.select(*unit, F.posexplode("tokens").alias("pos", "t")).select(*unit, "pos", "t.form", "t.tag").filter(F.col("tag").isin("NNG", "NNP"))
    island = F.col("pos") - F.row_number().over(Window.partitionBy(*unit).orderBy("pos"))
    runs = t.withColumn("island", island).groupBy(*unit, "island").agg(F.min("pos").alias("start"), F.array_sort(F.collect_list(F.struct("pos", "form"))).alias("r"), F.count("*").alias("n"), F.min_by("tag", "pos").alias("head_tag"))
    return runs.select(*unit, "start", F.array_join(F.transform("r", lambda x: x["form"]), "").alias("noun"), "n", "head_tag")
