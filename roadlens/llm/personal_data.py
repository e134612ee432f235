"""Personal data: base patterns, and spans that weak labelers, weighed by their agreement, add to them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.base import pieces, rows_out, schema_of
from roadlens.session import discard, settle

# The base kinds and their patterns. Emails are found from their @.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
PART = re.compile(r"[0-9]+")

# Words that stand before personal data or secrets, and values that are known to be examples.
CUES = frozenset(
    "password passwd pwd token secret key apikey api_key access_key auth bearer credential pin login user username "
    "ssn passport iban account kennwort passwort contraseña contrasena clave mot_de_passe tel phone call".split()
)
EXAMPLES = frozenset("password changeme secret example test null none true false xxxxxxxx 12345678 undefined".split())
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_live_", "xoxb-", "xoxp-", "AIza", "eyJ", "glpat-", "-----BEGIN")

#: Words that may stand between a cue and its value.
FILLERS = frozenset("number no nr nummer num numero número numéro id is ist es est code".split())
TITLES = frozenset("Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra".split())
#: Words that introduce a name, and words that make a place or a company of capitalised words.
INTRODUCED = re.compile(
    r"(?:\b(?:name is|named|called|signed|dear|contact|author|my friend|regards,|ich heiße|mein name ist|je m'appelle|"
    r"me llamo|mi nombre es)\s+)$", re.I,
)
PLACES = frozenset(
    "Street Avenue Road Lane Square Park Bridge River Lake Mountain Island Airport Station University College School "
    "Hospital Church Museum Hotel Inc Ltd Corp Company Bank Foundation Institute County City Straße Platz GmbH AG Rue Calle".split()
)
#: Given names; with a capitalised word behind they make a name, as do a title or an introduction before.
NAMES = frozenset("""
Adam Alain Alejandro Alexander Alice Amanda Amy Ana Andrea Andreas Andrew Angela Anna Anne Anthony Antonio Barbara
Benjamin Bernard Birgit Brian Camille Carlos Carmen Catherine Charles Charlotte Christian Christine Christopher Claire
Claudia Daniel David Deborah Diego Donald Dorothy Edward Elena Elisabeth Elizabeth Emily Emma Eric Eva Fernando Florian
Francisco Frank Frédéric Gabriel George Gérard Hans Heike Helen Helga Henry Isabel Isabelle Jack Jacob Jacques James Jan
Javier Jean Jennifer Jessica Joan John Jonas Jorge Joseph José Juan Julia Julie Julien Jürgen Karen Karin Katharina
Kevin Klaus Laura Lea Linda Lisa Louis Lucas Lucía Luis Lukas Manuel Marco Margaret María Marie Mark Markus Martin Mary
Matthew Max Michael Michel Miguel Monika Nancy Nathalie Nicolas Olivier Pablo Patricia Paul Pedro Peter Petra Philippe
Pierre Rafael Rebecca Richard Robert Rosa Ruth Sabine Samuel Sandra Sarah Sebastian Sharon Sofía Sophie Stefan Stephen
Steven Susan Susanne Sylvie Teresa Thomas Ursula Valérie Véronique Walter William Wolfgang
""".split())

#: Runs of token characters, candidates where they mix digits with letters or begin like a known key.
CANDIDATE = re.compile(r"[A-Za-z0-9_\-+/.~]{6,}+")
#: What stands behind a cue: a filler, marks, then groups of digits or a run up to white space or a mark.
BEHIND = re.compile(
    rf"(?:[\x20\t]+(?:{'|'.join(sorted(FILLERS))})(?![\w])\.?)?[\x20\t\"'=:#]{{1,8}}"
    r"([0-9]{2,}+(?:[\x20-][0-9]{2,}+)*+(?![\w-])|[^\s\"'<>,;=()]+)", re.I,
)
SOCIAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
CAPITAL = r"[A-ZÀ-ÖØ-Þ][a-zA-ZÀ-ÖØ-öø-ÿ'’-]+"
NAME = re.compile(rf"(?<!\w)({CAPITAL})\.?((?:\x20[A-Z]\.)?(?:\x20{CAPITAL}){{1,3}})")
ADDED = ("name", "ssn", "iban", "secret")
#: Who votes on spans of each kind.
LABELERS = {
    "name": ("given", "title", "introduced", "place"),
    "ssn": ("shape", "cue", "range"),
    "iban": ("check_digits", "cue"),
    "secret": ("known_prefix", "hex", "key_shape", "cue", "assigned", "quoted", "mixed", "number", "example", "word_like"),
}
#: The share of personal spans among candidates of a kind, which is not estimated: votes of one form cannot move it.
PRIOR = {"name": 0.5, "ssn": 0.5, "iban": 0.5, "secret": 0.3}
#: How often a labeler's vote is held to be right before any is seen.
EXPECTED = {
    "given": 0.85, "title": 0.85, "introduced": 0.8, "place": 0.95, "shape": 0.85, "range": 0.97, "check_digits": 0.95,
    "known_prefix": 0.95, "hex": 0.9, "key_shape": 0.85, "cue": 0.75, "assigned": 0.75, "quoted": 0.6, "mixed": 0.75, "number": 0.75,
    "example": 0.97, "word_like": 0.85,
}
#: That counts as much as all votes seen of the labeler, and as so many more. No vote is held for surer than SUREST.
PSEUDO = 10
SUREST = 0.99
#: Candidates that the classifier of a kind is trained on at most, about; votes of all are counted.
SAMPLE = 20_000
DRAWS = 1 << 40
ROUNDS = 60
RIDGE = 1e-4

SHAPE = ("length", "digits", "upper", "lower", "others", "distinct", "changes", "vowels")
MAYBE = pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("pattern", pa.string()),
    ("features", pa.list_(pa.float64())), ("draw", pa.int64()),
])
FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()),
    ("n_phone", pa.int64()), ("base_spans", pa.list_(pa.string())), ("maybe", pa.list_(MAYBE)),
])
SPANS = pa.schema([*[f for f in FOUND if f.name != "maybe"], pa.field("all_spans", pa.list_(pa.string()))])

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        # the run of local characters before the @, back to the last match
        start = at
        while start > end and LOCAL_SET.get(text[start - 1]):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            yield start, m.end()
            end = at = m.end()
        else:
            at += 1


LOCAL_SET = {c: True for c in map(chr, range(128)) if LOCAL.fullmatch(c)}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base kinds' spans in code points, by kind as in KINDS, then start."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in PART.findall(m.group())):
                out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(len, PART.findall(m.group()))) <= 15:
                out.append(("phone", *m.span()))
    return out


def _lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def _behind_cues(text: str) -> Iterator[tuple[int, int]]:
    low = _lowered(text)
    for cue in CUES:
        at = low.find(cue)
        while at >= 0:
            end = at + len(cue)
            if not (at and (low[at - 1].isalnum() or low[at - 1] == "_")) and (m := BEHIND.match(text, end)):
                a, b = m.span(1)
                b -= len(m.group(1)) - len(m.group(1).rstrip(".:!?]}"))
                if b > a:
                    yield a, b
            at = low.find(cue, end)


def iban(value: str) -> bool:
    value = value.replace(" ", "")
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def candidates(text: str, taken: list[Span]) -> Iterator[tuple[int, int, int, int, str]]:
    """What may be personal or secret outside the spans taken: start, end, and start, end and kind of the run it is of.

    Runs are given by patterns (``ssn``, ``iban``), as capitalised words that a given name begins or a title or an
    introduction stands before (``name``), and as tokens that begin like a known key or mix digits and letters, or
    stand behind a cue (``secret``). Of runs that overlap the one found first in this order stays, whole; of a run that
    overlaps a base span, what is left of it.
    """
    runs = [(*m.span(), "ssn") for m in SOCIAL.finditer(text)]
    runs += [(*m.span(), "iban") for m in IBAN.finditer(text) if iban(m.group())]
    for m in NAME.finditer(text):
        if m.group(1) in TITLES:
            runs.append((m.start(2) + 1, m.end(2), "name"))
        elif m.group(1) in NAMES or INTRODUCED.search(text, max(0, m.start() - 40), m.start()):
            runs.append((*m.span(), "name"))
    for m in CANDIDATE.finditer(text):
        value = m.group().rstrip(".-/")
        if value.startswith(PREFIXES) or (len(value) >= 6 and _mixed(value)):
            runs.append((m.start(), m.start() + len(value), "secret"))
    runs += [(a, b, "secret") for a, b in sorted(set(_behind_cues(text)))]
    if not runs:
        return
    base = sorted((a, b) for _, a, b in taken)
    kept: list[tuple[int, int, str]] = []
    end = -1
    order = {"ssn": 0, "iban": 0, "name": 1, "secret": 2}
    for a, b, kind in sorted(runs, key=lambda r: (r[0], order[r[2]], -r[1])):
        if a >= end:
            kept.append((a, b, kind))
            end = b
        elif order[kind] < order[kept[-1][2]]:  # a token that a pattern or the list knows better
            kept[-1] = (a, b, kind)
            end = max(end, b)
    k = 0
    for a, b, kind in kept:
        while k < len(base) and base[k][1] <= a:
            k += 1
        at, j = a, k
        while at < b:
            stop = min(b, base[j][0]) if j < len(base) else b
            piece = text[at:stop]
            if core := piece.strip("./-+_~ ") if (at, stop) != (a, b) else piece:
                first = at + piece.index(core)
                yield first, first + len(core), a, b, kind
            if j == len(base) or base[j][0] >= b:
                break
            at = max(at, base[j][1])
            j += 1


def _mixed(value: str) -> bool:
    return any(c in "0123456789" for c in value) and any(c.isalpha() for c in value)


def votes(text: str, a: int, b: int, kind: str = "secret") -> str:
    """The vote of each labeler of ``kind`` on a run: + personal or secret, - not, 0 no opinion."""
    value, before = text[a:b], text[max(0, a - 40) : a]
    if kind == "name":
        return _name_votes(value, before)
    if kind == "ssn":
        area, group, serial = value.split("-")
        wrong = area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000"
        return "".join(("+", "+" if re.search("ssn|social|security", before, re.I) else "0", "-" if wrong else "0"))
    if kind == "iban":
        return "".join(("+", "+" if re.search("iban|konto|account|bank|compte|cuenta", before, re.I) else "0"))
    bare = before.rstrip(" \t\"'=:#")
    joint = before[len(bare) :]
    words = [w for w in re.split(r"[^\w]+", bare.lower()) if w]
    if words and words[-1] in FILLERS and bare[-1:] in (".", *words[-1]):
        words.pop()
    cue = bool(words) and words[-1] in CUES
    digits = sum(c in "0123456789" for c in value)
    hexes = all(c in "0123456789abcdefABCDEF" for c in value)
    upper = value.isupper()
    longest = max(map(len, re.split(r"[^A-Za-z]+", value)))
    assigned, known = "=" in joint or ":" in joint, value.startswith(PREFIXES)
    told = known or (cue and assigned)  # then letters alone say nothing against it
    return "".join((
        "+" if known else "0",
        "+" if hexes and len(value) >= 16 and digits >= 4 else "0",
        "+" if upper and len(value) >= 16 and (digits >= 1 or known) else "0",
        "+" if cue and (digits or assigned) else "0",
        "+" if assigned else "0" if cue and digits >= 4 else "-",
        "+" if joint[-1:] in ("'", '"') and joint[-1:] else "0",
        "+" if len(value) >= 10 and digits >= 3 and len(value) - digits >= 3 else "-" if digits < 2 and not told else "0",
        "+" if cue and digits >= 4 and not any(map(str.isalpha, value)) else "0",
        "-" if value.lower() in EXAMPLES else "0",
        "-" if longest >= 0.75 * len(value) and not upper and not told else "0",
    ))


def _name_votes(value: str, before: str) -> str:
    words = re.findall(r"[\w'’-]+", value)
    last = re.search(r"(\w+)\.?\x20$", before)
    return "".join((
        "+" if words[0] in NAMES else "0",
        "+" if last and last.group(1) in TITLES else "0",
        "+" if INTRODUCED.search(before) else "0",
        "-" if any(w in PLACES for w in words) else "0",
    ))


def span_features(value: str, pattern: str) -> list[float]:
    n = len(value)
    digits = sum(c in "0123456789" for c in value)
    kinds = ["d" if c in "0123456789" else "a" if c.isalpha() else "o" for c in value]
    return [
        min(n, 64) / 16, digits / n, sum(map(str.isupper, value)) / n, sum(map(str.islower, value)) / n,
        kinds.count("o") / n, len(set(value)) / n, sum(x != y for x, y in zip(kinds, kinds[1:], strict=False)) / n,
        sum(c in "aeiouAEIOU" for c in value) / n, *[{"+": 1.0, "-": -1.0, "0": 0.0}[v] for v in pattern],
    ]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for piece in pieces(batches):
        out: dict[str, list] = {name: [] for name in FOUND.names}
        for doc_id, text in zip(piece["doc_id"], piece["text"], strict=True):
            base = base_spans(text)
            maybe = []
            for a, b, c, d, kind in candidates(text, base):
                pattern, value = votes(text, c, d, kind), text[c:d]
                draw = xxhash.xxh3_64_intdigest(f"{doc_id}:{a}:{value}") % DRAWS
                maybe.append((a, b, kind, pattern, span_features(value, pattern), draw))
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            names = [f.name for f in MAYBE]
            values = (doc_id, *counts, [f"{k}:{a}:{b}" for k, a, b in base], [dict(zip(names, m, strict=True)) for m in maybe])
            for name, value in zip(FOUND.names, values, strict=True):
                out[name].append(value)
        yield rows_out(FOUND, out)


def reliabilities(patterns: list[str], n: np.ndarray, kind: str = "secret") -> tuple[np.ndarray, dict[str, float]]:
    """Chance that a span with each vote pattern is personal, by expectation maximisation over one kind's spans.

    A labeler's vote is right with a chance of its own, estimated as the share of
    its votes that agree with what all votes together say; labelers err
    independently, and no vote says nothing. What is expected of a labeler weighs
    as much as all its votes, and it is never held to be wrong more often than
    right: so a + never lowers a span's chance and a - never raises it. The share
    of personal spans is fixed, so that one frequent pattern cannot turn votes
    around, and a span that no labeler votes + for stays at or below it.
    """
    names = LABELERS[kind]
    expected = np.array([EXPECTED[name] for name in names])
    if not len(patterns):
        return np.zeros(0), {}
    vote = np.array([[("-", "0", "+").index(v) - 1 for v in p] for p in patterns])
    right, good = expected, np.full(len(n), PRIOR[kind])
    for _ in range(ROUNDS):
        odds = np.log(PRIOR[kind] / (1 - PRIOR[kind])) + vote @ np.log(right / (1 - right))
        now = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        moved, good = np.abs(now - good).max(), now
        if moved < 1e-6:
            break
        agreed = np.where(vote > 0, good[:, None], 1 - good[:, None]) * (vote != 0) * n[:, None]
        votes_of = ((vote != 0) * n[:, None]).sum(axis=0)
        right = (agreed.sum(axis=0) + (votes_of + PSEUDO) * expected) / (2 * votes_of + PSEUDO)
        right = np.clip(right, 0.5, SUREST)
    return good, dict(zip(names, right.tolist(), strict=True))


@dataclass
class SpanModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def chance(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.spread, -6, 6)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[1:] + self.weights[0], -50, 50)))


def fit_spans(x: np.ndarray, chance: np.ndarray, weight: np.ndarray) -> SpanModel:
    """Logistic regression of the spans' features on the chances that the labelers' votes give."""
    model = SpanModel(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1] + 1))
    weight = weight / weight.sum()
    model.mean = weight @ x
    model.spread = np.maximum(np.sqrt(weight @ (x - model.mean) ** 2), 1e-3)
    z = np.concatenate([np.ones((len(x), 1)), np.clip((x - model.mean) / model.spread, -6, 6)], axis=1)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(z @ model.weights, -50, 50)))
        slope = z.T @ (weight * (p - chance)) + RIDGE * model.weights
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + RIDGE * np.eye(z.shape[1])
        step = np.linalg.solve(curve, slope)
        model.weights = model.weights - step * min(1.0, 4 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return model


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and candidates with their votes and features, one row per row of ``docs``; null text counts as empty."""
    return docs.select("doc_id", "text").mapInArrow(_scan, schema_of(FOUND))


def learn(found: DataFrame, sample: int = SAMPLE) -> dict[str, SpanModel]:
    """The span classifier of each kind from rows that ``scan`` gave and that were written, as they are read twice.

    Votes of all candidates are counted by kind and pattern; at most 3 to the
    number of labelers exist. Labelers are weighed by these counts, kind by kind.
    A kind's classifier is fitted on about ``sample`` candidates, shared out over
    the patterns evenly and chosen by a hash of their place, each weighing as
    many as it stands for. A kind without candidates has no classifier. Equal
    rows are counted and drawn each; ties cannot change the result.
    """
    each = found.select(F.explode("maybe").alias("m")).select("m.*")
    rows = sorted(tuple(r) for r in each.groupBy("kind", "pattern").agg(F.count("*")).collect())
    models = {}
    for kind in ADDED:
        patterns, n = [p for k, p, _ in rows if k == kind], np.array([c for k, _, c in rows if k == kind], float)
        if not patterns:
            continue
        chances, _ = reliabilities(patterns, n, kind)
        part = np.minimum(1, sample / len(patterns) / n)
        drawn_up_to = dict(zip(patterns, np.ceil(part * DRAWS).astype(int).tolist(), strict=True))
        cut = F.create_map(*[F.lit(v) for pair in drawn_up_to.items() for v in pair])
        drawn = each.filter(F.col("kind") == kind).filter(F.col("draw") < F.element_at(cut, F.col("pattern")))
        drawn = sorted((r["pattern"], r["features"]) for r in drawn.select("pattern", "features").collect())
        if drawn:
            of = dict(zip(patterns, zip(chances, n, strict=True), strict=True))
            many = Counter(p for p, _ in drawn)
            weight = np.array([of[p][1] / many[p] for p, _ in drawn])
            models[kind] = fit_spans(np.array([f for _, f in drawn]), np.array([of[p][0] for p, _ in drawn]), weight)
    return models


def learn_spans(docs: DataFrame, sample: int = SAMPLE) -> dict[str, SpanModel]:
    """The span classifiers of the texts of ``docs`` (doc_id, text)."""
    found = settle(scan(docs))
    models = learn(found, sample)
    discard(found)
    return models


def _decider(models: dict[str, SpanModel]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = []
            for base, maybe in zip(batch.column("base_spans").to_pylist(), batch.column("maybe").to_pylist(), strict=True):
                spans = list(base)
                for kind in ADDED:
                    own = [m for m in maybe if m["kind"] == kind] if maybe else []
                    if own and kind in models:
                        chance = models[kind].chance(np.array([m["features"] for m in own]))
                        spans += [f"{kind}:{m['start']}:{m['end']}" for m, c in zip(own, chance, strict=True) if c >= 0.5]
                named.append(spans)
            yield rows_out(SPANS, {n: named if n == "all_spans" else batch.column(n) for n in SPANS.names})

    return decide


def find_personal_data(docs: DataFrame, models: dict[str, SpanModel] | None = None) -> DataFrame:
    """Spans of personal data per row of ``docs`` (doc_id, text), with ``models``, or those learned from ``docs``.

    Columns: doc_id, n_email, n_ip, n_card, n_phone, base_spans and all_spans
    (kind:start:end in code points, end exclusive; by kind, base kinds first, then
    ADDED, and start). Base spans always stay; the others are candidates outside
    them that their kind's classifier holds for personal. Texts are searched
    once; votes and features are written where models are learned.

    Null text counts as empty and has no span. Repeated rows each get their row,
    of overlapping runs one stays, an empty table gives no rows, and without
    candidates of a kind none is added. A text is searched whole, however long.
    """
    found = scan(docs)
    if models is None:
        found = settle(found)
        models = learn(found)
    return found.mapInArrow(_decider(models), schema_of(SPANS))


def spans_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"),
        F.concat_ws(",", "all_spans").alias("spans"), F.size("all_spans").cast("long").alias("n_spans"),
    )


def redacted(text: str | None, spans: list[str]) -> str | None:
    """``text`` with each span's characters replaced by its kind in brackets."""
    if text is None:
        return None
    out, end = [], 0
    for a, b, kind in sorted((int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0]) for s in spans):
        if a >= end:
            out += [text[end:a], f"[{kind}]"]
            end = b
    return "".join([*out, text[end:]])
