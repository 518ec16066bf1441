"""Personal data by weak supervision, in column expressions only.

Patterns propose spans (`KINDS`). Four labelers vote on each one with -1, 0 or 1: the validator of the pattern, a
gazetteer (top level domains, card issuers, calling codes, first names, key names), the words before the span, and the
shape of its characters. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is
for each kind; its posteriors are the soft labels from which a logistic span classifier over the votes, a length class and
the neighbouring characters is trained. Valid spans of the four base kinds always count; others where the classifier says
so.

Only counts of patterns leave the executors: at most kinds x 3^4 votes x 4 lengths x 4 neighbourhoods = 7,776 rows,
whatever the input. Finding spans shuffles nothing, so hot sources and long texts stay where they are.

Cases: a null or empty text has no spans. Repeated rows get equal answers; an empty table trains nothing (every added
span then needs a majority of votes) and gives no rows. Positions count code points, ends are exclusive. Other columns
pass through `found` and `redacted` whatever their names. A text with k spans of one kind takes about k^2 / 256 short
steps for their places.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripspark.llm.frames import named, whole_text

# Patterns are written for linear time on long texts: runs are possessive, and start only where a run starts or the last
# match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9]){12,}+"  # whole runs; shorter ones never count
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
SECRET = r"(?i)(?<![a-z])(?:token|secret|api[_-]?key|password|passwd|bearer)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+=-]{12,}"
NAME = r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señor|Señora)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a cheap pattern without which a text has no span of this kind
    base: bool
    cues: str  # words before a span that speak for it
    doubts: str  # and against it


KINDS = (
    Kind("email", EMAIL, "@", True, "mail|contact|write|adress|address|correo|courriel", "example|noreply|invalid"),
    Kind("ip", IP, r"[0-9]\.[0-9]", True, "ip|host|server|address|adresse|ping", "version|release|chapter|section"),
    Kind("card", CARD, "[0-9]{2}|[0-9][ -][0-9]", True, "card|visa|karte|carte|tarjeta|credit", "isbn|order|invoice|serial"),
    Kind("phone", PHONE, r"\+[0-9]", True, "phone|call|tel|mobil|fax|anruf", "score|version|utc|gmt"),
    Kind("secret", SECRET, "[=:]", False, "config|export|login|auth|env|header", "placeholder|changeme|sample"),
    Kind("name", NAME, "M|D|P|H|F|S", False, "dear|from|by|sincerely|author|von|par|por", "street|avenue|university"),
)
BASE = tuple(k.name for k in KINDS if k.base)

# Common entries, as the gazetteer's evidence; an entry that is missing only means no vote.
DOMAINS = "com org net edu gov io de fr es uk eu ch at it nl info".split()
ISSUERS = "4 51 52 53 54 55 34 37 6011 65 35 36 22 23 24 25 26 27".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92".split()
FIRST_NAMES = "Anna Maria Peter Paul John Mary James Robert Michael Thomas Hans Karl Jean Marie Pierre Luis Carlos Ana Juan".split()

LABELERS = ("validator", "gazetteer", "context", "shape")
BEFORE = 40  # code points that the context labeler reads, back to the last match of the kind at most
ROUNDS = 25
THRESHOLD = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.when(
            F.length(_digits(value)).between(13, 19), _luhn(_digits(value))
        ).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "secret":
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return F.lit(True)


def _proposed(kind: str, value: Column) -> Column:
    """Matches that are worth a vote; the others are no candidates at all."""
    if kind == "card":
        return F.length(_digits(value)).between(13, 19)
    return F.lit(True)


def _listed(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lower(F.substring_index(value, ".", -1)).isin(*DOMAINS)
    if kind == "ip":
        return ~value.rlike(r"^(?:0|1|2|127)\.")
    if kind == "card":
        return value.rlike("^(?:" + "|".join(ISSUERS) + ")")
    if kind == "phone":
        return _digits(value).rlike("^(?:" + "|".join(CALLING) + ")")
    if kind == "secret":
        return value.rlike("(?i)^(?:token|api|secret)")
    return value.rlike("(?:" + "|".join(FIRST_NAMES) + ")")


def _plain_shape(kind: str, value: Column) -> Column:
    """-1 for spans that look made up, 1 for the usual length, else 0."""
    same = _digits(value).rlike(r"^([0-9])\1{6,}$") | value.rlike("(?:0123456789|1234567890|12345678)")
    usual = {"email": (6, 64), "ip": (7, 15), "card": (15, 19), "phone": (10, 20), "secret": (24, 120), "name": (8, 40)}
    return F.when(same, -1).when(F.length(value).between(*usual[kind]), 1).otherwise(0)


STRIDE = 256


def _bound(value: Column, function) -> Column:
    """`function` of a value that is computed once, also where the function uses it for every element of an array."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, n: a + n)


def _stride_sums(lengths: Column) -> Column:
    last = F.floor(F.size(lengths) / STRIDE).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda b: _sum(F.slice(lengths, b * STRIDE + 1, F.lit(STRIDE)))
    )


def _starts(kind: Kind, text: Column) -> Column:
    """Structs (start, value, before, after) of all matches of one kind, in order.

    What stands before and after is cut from the gaps between matches, so no place of a long text is sought again.

    A match starts after all gaps and matches before it. Their lengths are added up by whole strides first, so k matches
    take about k * k / STRIDE steps.
    """
    gaps = F.split(text, kind.pattern, -1)
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,value:string,before:string,after:string>>")

    def placed(values: Column, gaps: Column) -> Column:
        lengths = F.transform(values, lambda v, i: F.length(v) + F.length(F.get(gaps, i)))

        def with_sums(lengths: Column, strides: Column) -> Column:
            def start(v: Column, i: Column) -> Column:
                full = F.floor(i / STRIDE).cast("int")
                before = _sum(F.slice(strides, F.lit(1), full)) + _sum(
                    F.slice(lengths, full * STRIDE + 1, i % STRIDE)
                )
                return F.struct(
                    (before + F.length(F.get(gaps, i))).alias("start"),
                    v.alias("value"),
                    F.lower(F.right(F.get(gaps, i), F.lit(BEFORE))).alias("before"),
                    F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
                )

            return F.transform(values, start)

        return _bound(lengths, lambda ls: _bound(_stride_sums(ls), lambda ss: with_sums(ls, ss)))

    found = _bound(values, lambda vs: _bound(gaps, lambda gs: placed(vs, gs)))
    return F.when(text.rlike(kind.needs), found).otherwise(none)


def _described(rank: int, kind: Kind, e: Column) -> Column:
    value, start = e["value"], e["start"]
    end = start + F.length(value)
    before, after = e["before"], e["after"]
    valid = _valid(kind.name, value)
    votes = (
        F.when(valid, 1).otherwise(-1),
        F.when(_listed(kind.name, value), 1).otherwise(0),
        F.when(before.rlike(kind.doubts), -1).when(before.rlike(kind.cues), 1).otherwise(0),
        _plain_shape(kind.name, value),
    )
    n = F.length(value)
    length = F.when(n < 10, 0).when(n < 16, 1).when(n < 32, 2).otherwise(3)
    left = F.when(before.rlike(r"[\p{L}0-9]$"), 1).otherwise(0)
    right = F.when(after.rlike(r"[\p{L}0-9]"), 1).otherwise(0)
    features = F.array(
        *[F.concat(F.lit(f"{kind.name}/{name}="), v.cast("string")) for name, v in zip(LABELERS, votes)],
        F.concat(F.lit(f"{kind.name}/length="), length.cast("string")),
        F.concat(F.lit(f"{kind.name}/sides="), (2 * left + right).cast("string")),
    )
    return F.struct(
        F.lit(rank).alias("rank"),
        F.lit(kind.name).alias("kind"),
        start.alias("start"),
        end.alias("end"),
        (F.lit(kind.base) & valid).alias("base"),
        features.alias("features"),
    )


def _spans_of(text: Column, rank: int, kind: Kind) -> Column:
    proposed = F.filter(_starts(kind, text), lambda e: _proposed(kind.name, e["value"]))
    return F.transform(proposed, lambda e: _described(rank, kind, e))


def _candidates(text: Column) -> Column:
    """All proposed spans of a text, by kind as listed, then start: rank, kind, start, end, base, features."""
    return F.concat(*[_spans_of(text, rank, kind) for rank, kind in enumerate(KINDS)])


@dataclass
class SpanModel:
    """What training gives: labeler reliabilities, and the weights of the span classifier."""

    reliability: dict[str, float] = field(default_factory=dict)  # "kind/labeler=vote" -> log odds for personal data
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def score(self, features: Column) -> Column:
        if not self.weights:  # nothing to learn from: the mean vote decides
            votes = F.transform(
                F.slice(features, 1, len(LABELERS)), lambda f: F.substring_index(f, "=", -1).cast("double")
            )
            total = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-(total - 1.5)))
        table = F.create_map(*[F.lit(x) for kv in sorted(self.weights.items()) for x in kv])
        total = F.aggregate(
            features, F.lit(self.bias), lambda a, f: a + F.coalesce(F.element_at(table, f), F.lit(0.0))
        )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def trained(df: DataFrame, text: str = "text", rounds: int = ROUNDS) -> SpanModel:
    """Counts vote patterns over all texts and fits the model to the counts."""
    spans = df.select(F.explode(_candidates(whole_text(text))).alias("s"))
    counts = spans.groupBy(F.col("s.features").alias("features")).agg(F.count(F.lit(1)).alias("n"))
    return fitted([(tuple(r["features"]), r["n"]) for r in counts.collect()], rounds)


def fitted(patterns: list[tuple[tuple[str, ...], int]], rounds: int = ROUNDS) -> SpanModel:
    """EM over (features, count) rows with conditionally independent labelers, then logistic regression on posteriors."""
    if not patterns:
        return SpanModel()
    patterns = sorted(patterns)
    votes = [p[: len(LABELERS)] for p, _ in patterns]
    kinds = [p[0].split("/")[0] for p, _ in patterns]
    counts = [n for _, n in patterns]
    vote_sum = [sum(int(f.split("=")[1]) for f in v) for v in votes]
    posterior = [1 / (1 + math.exp(-s)) for s in vote_sum]  # start: the more votes, the likelier
    odds: dict[str, float] = {}
    for _ in range(rounds):
        prior: dict[str, list[float]] = {}
        seen: dict[str, list[float]] = {}
        for kind, v, n, p in zip(kinds, votes, counts, posterior):
            for key, into in [(kind, prior)] + [(f, seen) for f in v]:
                row = into.setdefault(key, [1.0, 1.0])
                row[0] += n * (1 - p)
                row[1] += n * p
        total: dict[str, list[float]] = {}
        for f, (no, yes) in seen.items():
            row = total.setdefault(f.split("=")[0], [0.0, 0.0])
            row[0] += no
            row[1] += yes
        odds = {
            f: math.log(yes / total[f.split("=")[0]][1]) - math.log(no / total[f.split("=")[0]][0])
            for f, (no, yes) in seen.items()
        }
        start = {kind: math.log(yes / no) for kind, (no, yes) in prior.items()}
        posterior = [
            1 / (1 + math.exp(-max(-30.0, min(30.0, start[k] + sum(odds[f] for f in v))))) for k, v in zip(kinds, votes)
        ]
    return _classifier(patterns, posterior, odds)


def _classifier(patterns, posterior, reliability, steps: int = 200, rate: float = 0.5, decay: float = 1e-3) -> SpanModel:
    names = sorted({f for p, _ in patterns for f in p})
    place = {f: i for i, f in enumerate(names)}
    rows = [[place[f] for f in p] for p, _ in patterns]
    # Counts enter by their root, so that a pattern seen a million times doesn't drown the others.
    weight = [math.sqrt(n) for _, n in patterns]
    whole = sum(weight)
    w, bias, speed = [0.0] * len(names), 0.0, [1e-8] * (len(names) + 1)
    for _ in range(steps):
        grad, grad_bias = [decay * x for x in w], 0.0
        for row, n, p in zip(rows, weight, posterior):
            z = max(-30.0, min(30.0, bias + sum(w[i] for i in row)))
            g = (1 / (1 + math.exp(-z)) - p) * n / whole
            grad_bias += g
            for i in row:
                grad[i] += g
        for i, g in enumerate([*grad, grad_bias]):
            speed[i] += g * g
            step = rate * g / math.sqrt(speed[i])
            if i < len(w):
                w[i] -= step
            else:
                bias -= step
    return SpanModel(reliability, dict(zip(names, w)), bias)


def found(df: DataFrame, text: str = "text", model: SpanModel | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Each row as a struct `row`, with `spans`: (rank, kind, start, end, base, score) by kind as listed, then start."""
    model = model or trained(df, text)
    spans = F.transform(
        _candidates(whole_text(text)),
        lambda s: F.struct(
            s["rank"].alias("rank"),
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["base"].alias("base"),
            model.score(s["features"]).alias("score"),
        ),
    )
    kept = F.filter(spans, lambda s: s["base"] | (s["score"] >= threshold))
    return df.select(F.struct("*").alias("row"), kept.alias("spans"))


def redacted(df: DataFrame, text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """The same columns; each span, or run of overlapping spans, gives way to its kind in square brackets."""
    x = F.coalesce(F.col("row")[text], F.lit(""))
    by_start = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    merged = F.aggregate(
        by_start,
        F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (s["start"] < F.get(a, F.size(a) - 1)["end"]),
            F.array_append(
                F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))),
                F.struct(
                    F.get(a, F.size(a) - 1)["start"].alias("start"),
                    F.greatest(F.get(a, F.size(a) - 1)["end"], s["end"]).alias("end"),
                    F.get(a, F.size(a) - 1)["kind"].alias("kind"),
                ),
            ),
        ).otherwise(F.array_append(a, s)),
    )
    rows = found(df, text, model).withColumn("merged", merged)
    m = F.col("merged")
    from_ = lambda i: F.coalesce(F.get(m, i - 1)["end"], F.lit(0))
    pieces = F.transform(
        m,
        lambda s, i: F.concat(
            F.substr(x, from_(i) + 1, s["start"] - from_(i)), F.lit("["), F.upper(s["kind"]), F.lit("]")
        ),
    )
    tail = F.substr(x, F.coalesce(F.get(m, F.size(m) - 1)["end"], F.lit(0)) + 1)
    clean = F.when(F.size(m) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col("row")[text])
    return rows.select(F.col("row").withField("`" + text + "`", clean).alias("row")).select("row.*")
