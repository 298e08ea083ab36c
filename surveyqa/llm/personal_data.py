"""Personal data in texts by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Method. Four base kinds follow fixed patterns and always stay. Wider candidates (numbers with separators,
capitalised names, addresses, written-out mail addresses and so on) get votes from labelers: the form of
the span, gazetteers, words before and after it, other personal data nearby, placeholder values. No
candidate has a true label. Expectation-maximisation over all candidates of the corpus estimates each
kind's share of personal data and how each labeler votes on personal and other spans, starting from
labelers that are somewhat better than chance; it runs on a table of vote patterns with their counts. The
posteriors are the soft labels of the final classifier, a logistic regression on features that no labeler
reads: kind, length, digits, separators, neighbouring characters, and the hashed word before the span. It is
fitted on the counts of feature patterns of all candidates, not on a sample, and decides each candidate.

Sizes. Texts are searched one by one in their tasks; the patterns' counts reach the driver, at most kinds x
3^labelers x feature patterns (``SHAPES`` x ``CONTEXTS``), whatever the corpus.

Results. One row per input row. Positions count code points from 0, ends exclusive. A null or empty text has
no spans. Spans of one base kind never overlap; an added span overlaps no base span and no added one of an
earlier kind. Repeated rows are searched each on its own and count each as evidence. Without candidates
nothing is added; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa.llm.storage import shared_folder, staged

BASE = ("email", "ip", "card", "phone")
WIDER = ("written_email", "local_phone", "ssn", "account", "iban", "birth", "mac", "ipv6", "address", "name")
KINDS = BASE + WIDER
LABELERS = ("form", "gazetteer", "cue", "counter_cue", "neighbour", "placeholder")
#: Characters before and after a span that its labelers read, hashed words before it, and the distance of a neighbour.
AROUND, CONTEXTS, NEAR = 40, 64, 120
#: Feature patterns of a span: four lengths, four numbers of digits, four of separators, three kinds of neighbours.
SHAPES = 4 * 4 * 4 * 3
#: The least probability of an added span.
ACCEPTED = 0.5

# Base patterns. Quantifiers that never give back, and starts at a run's first character only, keep them linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider candidates.
AT = re.compile(r"[\[({ ]at[\])} ]", re.I)
WRITTEN_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?\Z")
WRITTEN_AFTER = re.compile(r"\s?[A-Za-z0-9-]{2,63}(?:\s?[\[({ ]dot[\])} ]\s?[A-Za-z0-9-]{2,63}){1,4}", re.I)
NUMBER = re.compile(r"\(?[0-9][0-9 ()./-]{4,38}[0-9]")
LOCAL_PHONE = re.compile(r"\(?0?[1-9][0-9]{1,4}\)?[ ./-][0-9]{3,4}[ ./-]?[0-9]{3,5}")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
BIRTH = re.compile(r"(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{2}|[0-9]{4})|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2})")
ACCOUNT = re.compile(r"[0-9][0-9 -]{5,28}[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
MAC = re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:-])")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
STREET = re.compile(r"[0-9]{1,5}[A-Za-z]? (?:[A-Z][\w'.-]{1,30} ){1,4}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Court|Ct|Square|Sq|Way|Place|Pl)\b")
NAME = re.compile(r"[A-Z][a-zà-öø-ÿ]{2,20}(?: [A-Z][a-zà-öø-ÿ'-]{1,30}){1,3}")

# Gazetteers and cue words.
GIVEN = frozenset(
    "james mary robert patricia john jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah "
    "charles karen daniel nancy matthew lisa anthony margaret mark sandra paul emily steven donna andrew michelle kenneth carol george "
    "amanda edward melissa brian deborah ronald stephanie kevin rebecca jason laura jeffrey helen peter anna maria jose juan carlos luis "
    "carmen ana pedro miguel antonio francisco manuel jean pierre marie jacques michel philippe nathalie isabelle claire hans klaus "
    "wolfgang heinz ursula monika petra stefan andreas sabine mohammed fatima ahmed wei ming yuki hiroshi olga ivan svetlana".split()
)
TOP_DOMAINS = frozenset("com org net edu gov info io co uk de fr es it nl eu us ca au jp cn ru br mx ch at be se no dk fi pl".split())
COUNTRIES = frozenset("AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM TR".split())
FREE_CODES = frozenset("800 833 844 855 866 877 888 900 555".split())
CUES = {
    "written_email": r"e-?mail|mail|contact|write|reach", "local_phone": r"phone|tel|call|mobile|cell|fax|contact|ring|sms|whatsapp",
    "ssn": r"ssn|social|security|tax", "account": r"account|acct|card|passport|licen[cs]e|insurance|iban|customer id|tax id|patient|ausweis|cuenta|compte|konto",
    "iban": r"iban|account|bank|konto|compte|cuenta|transfer", "birth": r"born|birth|dob|geboren|n[ée]e? le|nacid[oa]|age",
    "mac": r"mac|device|hardware|adapter", "ipv6": r"ip|address|host|visitor|login|client",
    "address": r"live|address|resid|home|street|ship|deliver|wohn|adresse|direcci", "name": r"name|mr|mrs|ms|dr|dear|sincerely|regards|signed|contact|patient|se[ñn]ora?|herr|frau|madame|monsieur",
}
CUE = {kind: re.compile(rf"\b(?:{words})\b", re.I) for kind, words in CUES.items()}
COUNTER = re.compile(r"\b(?:version|isbn|issn|order|invoice|part|model|serial|page|chapter|price|total|example|sample|figure|table|section|score|ratio)\b", re.I)
LAST_WORD = re.compile(r"[^\W\d_]+(?=[\W\d_]*\Z)")


@dataclass(frozen=True)
class Candidate:
    kind: int
    start: int
    end: int
    votes: int
    shape: int
    context: int


def luhn(digits: str) -> bool:
    """The check digit of ISO/IEC 7812."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the run before it that no earlier match took."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of the base spans, in this order."""
    found = [(0, *span) for span in emails(text)]
    for match in ADDRESS.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found.append((1, *match.span()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = digits_of(match[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *match.span()))
    for match in PHONE.finditer(text):
        if 9 <= len(digits_of(match[0])) <= 15:
            found.append((3, *match.span()))
    return found


def numbered(kind: str) -> int:
    return KINDS.index(kind)


def wider_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Kind, start and end of everything that might be personal data besides the base spans."""
    for match in AT.finditer(text):
        before, after = WRITTEN_BEFORE.search(text, max(0, match.start() - 66), match.start()), WRITTEN_AFTER.match(text, match.end())
        if before and after:
            yield numbered("written_email"), before.start(), after.end()
    for match in NUMBER.finditer(text):
        number, (start, end) = match[0], match.span()
        if text[end : end + 1].isalnum() or text[start - 1 : start].isalnum():
            continue
        if SSN.fullmatch(number):
            yield numbered("ssn"), start, end
        elif BIRTH.fullmatch(number):
            yield numbered("birth"), start, end
        elif LOCAL_PHONE.fullmatch(number):
            yield numbered("local_phone"), start, end
        elif ACCOUNT.fullmatch(number) and CUE["account"].search(text, max(0, start - AROUND), start):
            yield numbered("account"), start, end
    colons = text.count(":")
    patterns = [("iban", IBAN), ("address", STREET), ("name", NAME)]
    patterns += [("mac", MAC)] if colons >= 5 or "-" in text else []
    patterns += [("ipv6", IPV6)] if colons >= 7 else []
    for kind, pattern in patterns:
        for match in pattern.finditer(text):
            start, end = named(text, *match.span()) if kind == "name" else match.span()
            if start < end:
                yield numbered(kind), start, end


def named(text: str, start: int, end: int) -> tuple[int, int]:
    """Capitalised words without a salutation before them; none of them without a given name or a cue."""
    first, rest = text[start:end].split(" ", 1)
    if " " in rest and CUE["name"].fullmatch(first):
        start += len(first) + 1
        first = rest.split(" ", 1)[0]
    some = first.lower() in GIVEN or CUE["name"].search(text, max(0, start - 16), start)
    return (start, end) if some else (start, start)


def good_form(kind: str, span: str, digits: str) -> int:
    """The form labeler: checks that the candidate's pattern doesn't make."""
    if kind == "ssn":
        return 1 if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000" else -1
    if kind == "iban":
        plain = span.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else -1
    if kind == "local_phone":
        return 1 if 9 <= len(digits) <= 12 else -1
    if kind == "birth":
        parts = sorted(map(int, re.split(r"[./-]", span)))
        return 1 if 1 <= parts[0] <= 12 and parts[1] <= 31 else -1
    if kind == "account":
        return 1 if 8 <= len(digits) <= 19 else -1
    if kind == "name":
        return 1 if 2 <= len(span.split(" ")) <= 3 else -1
    return 1 if kind in ("mac", "ipv6", "address", "written_email") else 0


def known(kind: str, span: str, digits: str) -> int:
    """The gazetteer labeler."""
    if kind == "name":
        return 1 if span.split(" ", 1)[0].lower() in GIVEN else -1
    if kind == "written_email":
        return 1 if re.split(r"\W+", span.lower().rstrip("])} "))[-1] in TOP_DOMAINS else -1
    if kind == "iban":
        return 1 if span[:2] in COUNTRIES else -1
    return -1 if kind == "local_phone" and digits[:3] in FREE_CODES else 0


def voted(text: str, kind: str, start: int, end: int, spots: np.ndarray) -> list[int]:
    """A vote of 1, 0 or -1 from each labeler."""
    span, digits = text[start:end], digits_of(text[start:end])
    before, after = max(0, start - AROUND), min(len(text), end + AROUND)
    cue = 1 if CUE[kind].search(text, before, start) or CUE[kind].search(text, end, after) else 0
    counter = -1 if COUNTER.search(text, before, start) else 0
    at = int(np.searchsorted(spots, start))
    near = 1 if any(abs(int(spot) - start) <= NEAR for spot in spots[max(0, at - 1) : at + 1]) else 0
    steps = {(ord(b) - ord(a)) % 10 for a, b in zip(digits, digits[1:])}
    placeholder = -1 if len(digits) >= 6 and len(steps) == 1 and steps <= {0, 1, 9} else 0
    return [good_form(kind, span, digits), known(kind, span, digits), cue, counter, near, placeholder]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[Candidate]:
    """Wider spans that overlap no base span and none of an earlier kind, with votes and features."""
    taken, kept = sorted((start, end) for _, start, end in base), []
    starts = np.array([s for s, _ in taken], np.int64)
    ends = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    own: list[tuple[int, int, int]] = []
    last_end: dict[int, int] = {}
    for kind, start, end in sorted(wider_spans(text)):
        k = int(np.searchsorted(starts, end)) - 1
        if (k >= 0 and ends[k] > start) or last_end.get(kind, 0) > start:
            continue
        last_end[kind] = end
        own.append((kind, start, end))
    covered: list[tuple[int, int]] = []
    for kind in sorted({k for k, _, _ in own}):
        mine = [(s, e) for k, s, e in own if k == kind]
        at = np.array([s for s, _ in covered], np.int64)
        for start, end in mine:
            k = int(np.searchsorted(at, end)) - 1
            if k < 0 or covered[k][1] <= start:
                kept.append((kind, start, end))
        covered = sorted(covered + [(s, e) for k, s, e in kept if k == kind])
    found = []
    for kind, start, end in kept:
        span = text[start:end]
        votes = 0
        for vote in voted(text, KINDS[kind], start, end, starts):
            votes = 3 * votes + vote + 1
        size, digits = end - start, len(digits_of(span))
        separators = sum(not c.isalnum() for c in span)
        edge = text[start - 1 : start]
        shape = (
            min(3, size // 8) * 48 + min(3, digits // 5) * 12 + min(3, separators) * 3
            + (0 if not edge or edge.isspace() else 1 if edge in "([<\"':=" else 2)
        )
        word = LAST_WORD.search(text, max(0, start - AROUND), start)
        context = zlib.crc32(word[0].lower().encode()) % CONTEXTS if word else 0
        found.append(Candidate(kind, start, end, votes, shape, context))
    return found


FOUND = "base array<struct<kind: int, start: int, stop: int>>, wider array<struct<kind: int, start: int, stop: int, votes: int, shape: int, context: int>>"
SPAN = pa.struct([(n, pa.int32()) for n in ("kind", "start", "stop")])
WIDE = pa.struct([(n, pa.int32()) for n in ("kind", "start", "stop", "votes", "shape", "context")])


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: base spans and wider candidates of every text."""
    for batch in batches:
        base, wider = [], []
        for value in batch["text"]:
            text = value.as_py() or ""
            spans = base_spans(text)
            base.append([{"kind": k, "start": s, "stop": e} for k, s, e in spans])
            wider.append([
                {"kind": c.kind, "start": c.start, "stop": c.end, "votes": c.votes, "shape": c.shape, "context": c.context}
                for c in candidates(text, spans)
            ])
        columns = [batch["id"], pa.array(base, pa.list_(SPAN)), pa.array(wider, pa.list_(WIDE))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "base", "wider"])


@dataclass(frozen=True)
class Reliabilities:
    """What expectation-maximisation found: shares by kind, and per labeler how both classes vote (-1, 0, 1)."""

    share: np.ndarray
    votes: np.ndarray

    def posterior(self, kind: np.ndarray, votes: np.ndarray) -> np.ndarray:
        """Probability of personal data for rows of votes (0, 1, 2 for -1, 0, 1)."""
        log = np.log(np.stack([1 - self.share[kind], self.share[kind]]))
        for j in range(votes.shape[1]):
            log += np.log(self.votes[j][:, votes[:, j]])
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def vote_matrix(codes: np.ndarray) -> np.ndarray:
    """Votes of each labeler from their number in base three."""
    return np.stack([codes // 3 ** (len(LABELERS) - 1 - j) % 3 for j in range(len(LABELERS))], axis=1)


def reliabilities(kind: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 4.0) -> Reliabilities:
    """Expectation-maximisation of a two-class model in which labelers vote independently given the class.

    ``prior`` imaginary spans of each class, voted on by labelers that are right twice as often as wrong,
    stand before the counts: they fix which class is personal data and keep probabilities off 0 and 1.
    """
    start = np.array([[[2.0, 2, 1], [1, 2, 2]]] * votes.shape[1]) / 5
    share, table = np.full(len(KINDS), 0.5), start
    for _ in range(rounds):
        p = Reliabilities(share, table).posterior(kind, votes)
        weight = np.stack([counts * (1 - p), counts * p])
        tally = np.stack([
            np.stack([np.bincount(votes[:, j], w, 3) for w in weight]) for j in range(votes.shape[1])
        ]) + prior * start
        table, before = tally / tally.sum(axis=2, keepdims=True), share
        both = np.bincount(kind, counts, len(KINDS))
        share = (np.bincount(kind, weight[1], len(KINDS)) + prior / 2) / (both + prior)
        if np.abs(share - before).max() < 1e-9:
            break
    return Reliabilities(share, table)


def columns_of(kind: np.ndarray, shape: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Positions of the features that are one in each row: kind, length, digits, separators, neighbour, word before."""
    sizes = [len(KINDS), 4, 4, 4, 3, CONTEXTS]
    parts = [kind, shape // 48 % 4, shape // 12 % 4, shape // 3 % 4, shape % 3, context]
    return np.stack([first + part for first, part in zip(np.cumsum([0, *sizes[:-1]]), parts)], axis=1)


def logistic(columns: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression on rows of ones, soft targets and counts, by Newton steps."""
    width = len(KINDS) + 4 + 4 + 4 + 3 + CONTEXTS
    rows = np.zeros((len(columns), width))
    np.put_along_axis(rows, columns, 1.0, axis=1)
    weights = np.zeros(width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (counts * (target - p)) - ridge * weights
        bend = (rows * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ rows + ridge * np.eye(width)
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def classifier(patterns: list[tuple[int, int, int, int, int]]) -> tuple[Reliabilities, np.ndarray]:
    """Reliabilities and weights from rows of kind, votes, shape, context and their count."""
    kind, codes, shape, context, counts = np.array(sorted(patterns), np.int64).T
    found = reliabilities(kind, vote_matrix(codes), counts.astype(float))
    soft = found.posterior(kind, vote_matrix(codes))
    return found, logistic(columns_of(kind, shape, context), soft, counts.astype(float))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, their digest, all spans and the number of added ones of every row; see the module."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    rows = staged(named.mapInArrow(searched, f"id {kind}, {FOUND}"), shared_folder(docs.sparkSession), "spans")
    features = ["kind", "votes", "shape", "context"]
    counted = rows.select(F.explode("wider").alias("w")).select("w.*").groupBy(*features).agg(F.count("*").alias("n"))
    patterns = [tuple(r) for r in counted.collect()]
    weights = classifier(patterns)[1] if patterns else None

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(len(BASE) + 3)]
            for base, wider in zip(batch["base"].to_pylist(), batch["wider"].to_pylist()):
                spans = [(s["kind"], s["start"], s["stop"]) for s in base]
                for k in range(len(BASE)):
                    out[k].append(sum(s[0] == k for s in spans))
                out[-3].append(hashlib.sha256(joined(spans).encode()).hexdigest())
                if wider:
                    fields = [np.array([w[f] for w in wider], np.int64) for f in ("kind", "shape", "context")]
                    sure = 1 / (1 + np.exp(-weights[columns_of(*fields)].sum(axis=1))) >= ACCEPTED
                    spans += [(w["kind"], w["start"], w["stop"]) for w, yes in zip(wider, sure) if yes]
                out[-2].append(joined(spans))
                out[-1].append(len(spans) - len(base))
            kinds = [pa.int64()] * len(BASE) + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch["id"], *[pa.array(c, t) for c, t in zip(out, kinds)]], names=names)

    names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "n_added"]
    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string, n_added long"
    return rows.mapInArrow(decided, schema)


def joined(spans: list[tuple[int, int, int]]) -> str:
    """Spans as text, by kind and start."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans))
