"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation
weighs them, and a span classifier trained on the result decides which candidates are added.

Column functions only. What reaches the driver is the number of candidates for each pattern of
votes, at most a few thousand rows whatever the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auricle.llm.common import stage

#: Kinds in the order in which spans are listed. The first four have base patterns, fixed values of
#: the contract, written so that no position is tried twice and no group repeats without bound: a
#: run of local characters, digits or blanks is entered at its start or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
    r"[A-Za-z0-9.-]*?(?=\.\.|\.?(?:[^A-Za-z0-9.-]|\z))",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser patterns whose matches are candidates only; kind, then pattern.
LOOSE = {
    "email_words": (
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({]at[\])}] ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:[\[({]dot[\])}]|\.) ?[A-Za-z0-9-]{1,63}){1,5}",
    ),
    "phone_local": (
        "phone",
        r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    ),
    "ssn": ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "name": (
        "name",
        r"(?<![\p{L}])(?:Mrs?|Ms|Dr|Herr|Frau|Mme|Sra?)\.? \p{Lu}\p{Ll}{1,30}(?: \p{Lu}\p{Ll}{1,30})?",
    ),
}
#: Cheap tests that a text must pass before a pattern is run on it.
HINTS = {
    "email": "instr(text, '@') > 0",
    "phone": "instr(text, '+') > 0",
    "email_words": "text rlike '[\\\\[({]at[\\\\])}]'",
}
KINDS = ["email", "ip", "card", "phone", "name", "ssn"]
BEFORE, AFTER = 40, 24
#: Gazetteers and context words, fixed lists.
TOP_DOMAINS = "com org net edu gov info io de fr es uk eu ch at it nl us ca".split()
GIVEN_NAMES = (
    "Ana Anna Carlos Claire Daniel David Elena Emma Hans James Jean John Jose Juan Julia Karl Laura "
    "Linda Luis Maria Marie Mary Michael Paul Peter Pierre Robert Sarah Sophie Thomas"
).split()
CONTEXT = {
    "email": "mail|contact|write|courriel|correo",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|mastercard|payment|carte|karte|tarjeta",
    "phone": "tel|phone|call|fax|mobile|anruf|llame|appel",
    "name": "dear|regards|sincerely|signed|contact|by|from",
    "ssn": "ssn|social|security|tax|id",
}
AGAINST = "version|isbn|issn|build|chapter|figure|page|serial|sku|ratio|score"
VOTES = ["form", "gazetteer", "context", "edges"]
ROUNDS = 60
THRESHOLD = 0.5


def _digits(column: str = "value") -> str:
    return f"regexp_replace({column}, '[^0-9]', '')"


def _luhn(column: str) -> str:
    digit = "cast(substring(r, -i, 1) as int)"
    body = f"case when i % 2 = 1 then {digit} else {digit} * 2 - if({digit} > 4, 9, 0) end"
    body = body.replace("substring(r, -i, 1)", f"substring({_digits(column)}, -i, 1)")
    return f"aggregate(sequence(1, length({_digits(column)})), 0, (s, i) -> s + {body}) % 10 = 0"


def _part(k: int) -> str:
    number = f"ltrim('0', split_part(value, '.', {k}))"
    return f"(length({number}) <= 3 and coalesce(cast(nullif({number}, '') as int), 0) <= 255)"


VALID = {
    "email": "true",
    "ip": " and ".join(_part(k) for k in range(1, 5)),
    "card": _luhn("value"),
    "phone": f"length({_digits()}) between 9 and 15",
}


def candidates(docs: DataFrame, *more: str) -> DataFrame:
    """(row, doc_id, found, …more) for every row of docs, written to the shared folder.

    row numbers the rows; found holds, by pattern, each match with its place in the order of
    matches, the characters since the match before it, and the text around it.
    """
    patterns = {k: (k, p) for k, p in BASE.items()} | LOOSE
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text,
        *[F.col(c).alias(f"kept_{c}") for c in more],
    )
    none = F.expr("cast(array() as array<string>)")
    matches, pieces, parts = [], [], []
    for name, (_, pattern) in patterns.items():
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        hint = HINTS.get(name, "text rlike '[0-9]'" if name != "name" else "true")
        matches.append(F.when(F.expr(hint), found).otherwise(none).alias(f"m_{name}"))
        split = F.split("text", pattern, -1)
        pieces.append(F.when(F.size(f"m_{name}") > 0, split).otherwise(none).alias(f"p_{name}"))
        parts.append(_described(name, patterns[name][0]))
    kept = ["row", "doc_id", *[f"kept_{c}" for c in more]]
    out = (
        rows.select(*kept, "text", *matches)
        .select(*kept, *[f"m_{n}" for n in patterns], *pieces)
        .select(*kept, F.concat(*parts).alias("found"))
    )
    return stage(out, "candidates")


def _described(name: str, kind: str) -> Column:
    def one(value: Column, k: Column) -> Column:
        before = F.element_at(f"p_{name}", k + 1)
        return F.struct(
            F.lit(name).alias("pattern"),
            F.lit(kind).alias("kind"),
            k.alias("k"),
            F.char_length(before).alias("gap"),
            value.alias("value"),
            F.right(before, F.lit(BEFORE)).alias("before"),
            F.left(F.element_at(f"p_{name}", k + 2), F.lit(AFTER)).alias("after"),
        )

    return F.transform(f"m_{name}", one)


def _one_of(column: str, kind: str, words: str) -> str:
    return f"(kind = '{kind}' and lower({column}) rlike '(?<![a-z])({words})')"


def voted(found: DataFrame) -> DataFrame:
    """One row per match: row, kind, start, end, base, and the labelers' votes (1, 0, -1: none)."""
    matches = found.select("row", F.explode("found").alias("f")).select("row", "f.*")
    order = Window.partitionBy("row", "pattern").orderBy("k")
    placed = matches.withColumn("size", F.char_length("value")).withColumn(
        "end", F.sum(F.col("gap") + F.col("size")).over(order)
    )
    strict = F.expr(
        "case pattern " + " ".join(f"when '{k}' then {v}" for k, v in VALID.items()) + " end"
    )
    names, domains = "|".join(GIVEN_NAMES), "|".join(TOP_DOMAINS)
    near = " or ".join(_one_of("before", k, w) for k, w in CONTEXT.items())
    gazetteer = f"""case
        when kind = 'email' then if(lower(value) rlike '[.\\\\])}} ]({domains})$', 1, 0)
        when kind = 'name' then if(value rlike ' ({names})( |$)', 1, -1)
        when kind = 'ip' then if(value rlike '^(0|127|255)[.]', 0, -1)
        when kind = 'ssn' then if(value rlike '^(000|666|9)|-00-|-0000$', 0, -1)
        when kind = 'card' then if({_digits()} rlike '^[3-6]', 1, 0)
        else if({_digits()} rlike '^(.)\\\\1*$', 0, -1) end"""
    edges = (
        "if(before rlike '[\\\\p{L}0-9@/=]$' or after rlike '^[\\\\p{L}0-9@/=]', 0, 1)"
    )
    return placed.select(
        "row",
        "pattern",
        "kind",
        (F.col("end") - F.col("size")).alias("start"),
        "end",
        F.coalesce(strict, F.lit(False)).alias("base"),
        F.when(strict, 1).when(~strict, 0).otherwise(-1).alias("form"),
        F.expr(gazetteer).alias("gazetteer"),
        F.expr(f"case when {near} then 1 when lower(before) rlike '({AGAINST})[^a-z]*$' then 0 "
               "else -1 end").alias("context"),
        F.expr(edges).alias("edges"),
    )


@dataclass
class Reliability:
    """Share of true candidates, and for each labeler the probability of each vote given truth."""

    prior: float
    votes: list[dict[int, tuple[float, float]]]  # vote -> (if true, if false)

    def posterior(self, votes: tuple[int, ...]) -> float:
        true, false = math.log(self.prior), math.log(1 - self.prior)
        for table, vote in zip(self.votes, votes):
            true += math.log(table[vote][0])
            false += math.log(table[vote][1])
        return 1 / (1 + math.exp(min(700, false - true)))


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> Reliability:
    """Expectation-maximisation over counted vote patterns, starting from a majority of the votes.

    Every probability has a prior worth a few candidates, a labeler being taken to be right more
    often than not, so a labeler that never votes, or a side that never occurs, stays defined.
    """
    state = Reliability(
        0.5, [{1: (0.6, 0.2), 0: (0.15, 0.55), -1: (0.25, 0.25)} for _ in VOTES]
    )
    start = state
    for _ in range(rounds):
        weight = {p: state.posterior(p) for p in patterns}
        total = sum(patterns.values())
        true = sum(n * weight[p] for p, n in patterns.items())
        tables = []
        for k, first in enumerate(start.votes):
            table = {}
            for vote, (a, b) in first.items():
                yes = sum(n * weight[p] for p, n in patterns.items() if p[k] == vote)
                no = sum(n * (1 - weight[p]) for p, n in patterns.items() if p[k] == vote)
                table[vote] = ((yes + 8 * a) / (true + 8), (no + 8 * b) / (total - true + 8))
            tables.append(table)
        state = Reliability((true + 4) / (total + 8), tables)
    return state


def _features(pattern: str, votes: tuple[int, ...]) -> list[int]:
    """Indexes of the ones among the classifier's 0/1 inputs."""
    sources = [*BASE, *LOOSE]
    out = [0, 1 + sources.index(pattern)]
    at = 1 + len(sources)
    for vote in votes:
        out.append(at + vote + 1)
        at += 3
    return out


def train(patterns: dict[tuple[str, tuple[int, ...]], int], rounds: int = 400) -> list[float]:
    """Weights of a logistic span classifier, trained on the posterior of each pattern.

    Gradient descent on the counted patterns, which equals training on every candidate.
    """
    votes: dict[tuple[int, ...], int] = {}
    for (_, key), n in patterns.items():
        votes[key] = votes.get(key, 0) + n
    belief = estimate(votes)
    width = 1 + len(BASE) + len(LOOSE) + 3 * len(VOTES)
    weights = [0.0] * width
    total = sum(patterns.values()) or 1
    rows = [(_features(p, v), n / total, belief.posterior(v)) for (p, v), n in patterns.items()]
    for _ in range(rounds):
        slope = [1e-4 * w for w in weights]
        for ones, share, target in rows:
            guess = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[k] for k in ones)))))
            for k in ones:
                slope[k] += share * (guess - target)
        weights = [w - 2.0 * s / (2 + len(VOTES)) * 2 for w, s in zip(weights, slope)]
    return weights


def _score(weights: list[float]) -> Column:
    """The classifier as a column over pattern and votes."""
    sources = [*BASE, *LOOSE]
    cases = " ".join(f"when '{n}' then {w!r}D" for n, w in zip(sources, weights[1:]))
    total = f"{weights[0]!r}D + case pattern {cases} end"
    at = 1 + len(sources)
    for vote in VOTES:
        none, no, yes = weights[at : at + 3]
        total += f" + case {vote} when -1 then {none!r}D when 0 then {no!r}D else {yes!r}D end"
        at += 3
    return F.expr(f"1 / (1 + exp(-({total})))")


def spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, base, score): base spans, and candidates the classifier adds.

    found: as candidates() returns. A candidate of a base pattern that fails its check is evidence
    only. A candidate that overlaps a base span, or an added one before it, is left out.
    """
    marked = stage(voted(found), "votes")
    counted = marked.groupBy("pattern", *VOTES).agg(F.count("*").alias("n")).collect()
    weights = train({(r["pattern"], tuple(r[v] for v in VOTES)): r["n"] for r in counted})
    scored = marked.withColumn("score", _score(weights)).where(
        F.col("base") | (~F.col("pattern").isin(list(BASE)) & (F.col("score") >= THRESHOLD))
    )
    ahead = Window.partitionBy("row").orderBy("start", "end", "pattern")
    before, after = ahead.rowsBetween(Window.unboundedPreceding, -1), ahead.rowsBetween(
        1, Window.unboundedFollowing
    )
    base_start = F.when(F.col("base"), F.col("start"))
    clear = F.coalesce(F.max("end").over(before) <= F.col("start"), F.lit(True)) & F.coalesce(
        F.min(base_start).over(after) >= F.col("end"), F.lit(True)
    )
    return scored.withColumn("clear", clear).where("base or clear").drop("clear")


def _listed(rows: str) -> Column:
    order = f"array({', '.join(repr(k) for k in KINDS)})"
    return F.expr(
        f"array_join(transform(array_sort(transform({rows}, s -> struct(array_position({order}, "
        "s.kind) as o, s.start as a, s.end as b, s.kind as kind))), "
        "s -> concat_ws(':', s.kind, s.a, s.b)), ',')"
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of docs.

    Counts and digest are of the base spans; spans lists all, by kind and start, offsets in code
    points. A null text is empty: zero counts and an empty list. Rows with equal ids are judged
    apart, a null id is kept. Extra columns are ignored; an empty table gives no rows.
    """
    found = candidates(docs)
    per_row = (
        spans(found)
        .groupBy("row")
        .agg(
            *[
                F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}")
                for k in BASE
            ],
            F.collect_list(F.struct("kind", "start", "end", "base")).alias("all"),
        )
    )
    joined = found.select("row", "doc_id").join(per_row, "row", "left")
    every = F.coalesce("all", F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,base:boolean>>)"))
    return joined.withColumn("all", every).select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed("filter(all, s -> s.base)").cast("binary"), 256).alias("base_sha256"),
        _listed("all").alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span in its text replaced by its kind, as [EMAIL]; columns unchanged.

    Overlapping spans are replaced together, by the first one's kind; n_chars, where there is such a
    column, follows the new text. Rows without spans keep their text as it is (null stays null).
    """
    others = [c for c in docs.columns if c != "doc_id"]
    found = candidates(docs, *docs.columns)
    found_spans = spans(found.select("row", "doc_id", "found"))
    ahead = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    opened = found_spans.withColumn("opens", F.coalesce(reach <= F.col("start"), F.lit(True)))
    blocks = (
        opened.withColumn("block", F.sum(F.col("opens").cast("int")).over(ahead))
        .groupBy("row", "block")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind"),
        )
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    )
    text = F.expr(
        "concat(array_join(transform(cuts, (c, i) -> concat(substring(kept_text, "
        "if(i = 0, 0, cuts[i - 1].end) + 1, c.start - if(i = 0, 0, cuts[i - 1].end)), "
        "'[', upper(c.kind), ']')), ''), "
        "substring(kept_text, cuts[size(cuts) - 1].end + 1))"
    )
    plain = found.where("size(found) = 0")
    marked = found.where("size(found) > 0").join(blocks, "row", "left")
    changed = marked.withColumn(
        "kept_text", F.when(F.col("cuts").isNull(), F.col("kept_text")).otherwise(text)
    )
    if "n_chars" in others:
        size = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn(
            "kept_n_chars", F.when(F.col("cuts").isNull(), F.col("kept_n_chars")).otherwise(size)
        )
    columns = [F.col(f"kept_{c}").alias(c) for c in docs.columns]
    return plain.select(*columns).union(changed.select(*columns))
