"""Identifier extraction as Column builders: text to arrays of 12-digit candidates. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that scans give for digits, the words that mark an identifier's neighbourhood, and, here and in the
#: functions below, the patterns of identifiers, which decide what is a candidate and so must not be changed.
CONFUSED, MEANT = "OQDILZSGBT", "0001125687"
CONTEXT_KEYWORDS = (
    "AWB", "AIR WAYBILL", "AIRWAY BILL", "AIRWAYBILL", "AIRWAY BILL NUMBER", "AIRWAYBILL NUMBER", "WAYBILL", "TRACKING", "TRACKING NUMBER", "SHIPMENT",
    "MASTER", "MAWB", "HAWB", "BILL NO", "BOL", "COMMERCIAL INVOICE", "C/I", "CI NO", "CI NUMBER", "AWB NO", "AWB NUMBER", "AWB#", "TRACKING #",
    "TRACKING NUM", "FEDEX TRACKING", "FED EX TRACKING", "AIR WAY BILL", "AIR WAY BILL NUMBER", "AIR WAYBILL NUMBER", "WAY BILL", "ACI", "ACI NO",
    "ACI NUMBER", "CARGO CONTROL NUMBER", "CARGO CONTROL NO", "CCN", "CONSIGNMENT", "CONSIGNMENT NO", "CONSIGNMENT NUMBER", "FDX", "FDE", "FDXE",
    "FEDEX", "FED-EX", "FDX TRACKING", "FDXE TRACKING", "SHIP", "TRK", "TRK#", "TRK NO", "TRK NUMBER", "TRACKING NO", "B/L", "B/L NO", "B/L NUMBER", "BL NO", "BL NUMBER",
)
CONTEXT_CHARS = 40
TWELVE, GROUPED = r"(?<!\d)(\d{12})(?!\d)", r"(?<!\d)(\d{4}[\s\-]\d{4}[\s\-]\d{4})(?!\d)"
STRICT = r"(\d{12}|\d{4}[\s\-]\d{4}[\s\-]\d{4})"
NUMBER_WORD = r"(?:NO\.?|NUM\.?|NUMBER|#)"

Text = Column | str


def _col(text: Text) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def _every(text: Text, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(group))


def _if(gate: Column, values: Column) -> Column:
    """An array where the gate, a cheap test that whatever has values passes, lets it be looked for."""
    return F.when(gate, values).otherwise(F.array().cast("array<string>"))


def _letters(text: Text, some: str) -> Column:
    """Whether a text has all of these letters, in either case."""
    upper, all_of = F.upper(_col(text)), F.lit(True)
    for c in some:
        all_of = all_of & upper.contains(c)
    return all_of


def _holds(text: Text, part: str) -> Column:
    return F.upper(_col(text)).contains(part)


def digits(text: Text) -> Column:
    return F.regexp_replace(_col(text), r"\D", "")


def _some(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull()))


def norm_digits(raw: Text) -> Column:
    """The 12 digits that a token of 12 letters and digits means; null unless 8 are digits and all letters are known."""
    x = F.regexp_replace(F.upper(_col(raw)), r"[\s\-:/._]+", "")
    mapped = F.translate(x, CONFUSED, MEANT)
    fits = (F.length(x) == 12) & (F.length(F.regexp_replace(x, r"[^0-9]", "")) >= 8) & mapped.rlike(r"^\d{12}$")
    return F.when(fits, mapped)


def clean_candidates(text: Text) -> Column:
    """Twelve digits in a row or in groups of four."""
    return F.array_distinct(F.concat(_every(text, TWELVE), F.transform(_every(text, GROUPED), digits)))


def alnum_candidates(text: Text, longest: int = 30) -> Column:
    """Spans of letters, digits and separators that mean 12 digits."""
    return _some(F.transform(_every(F.upper(_col(text)), rf"(?<![A-Z0-9])([A-Z0-9][A-Z0-9\-\s:/._]{{8,{longest}}}[A-Z0-9])(?![A-Z0-9])"), norm_digits))


def disqualified(candidate: Column, for_tolerance: bool = False) -> Column:
    return ~F.coalesce(candidate.rlike(r"^\d{12}$" if for_tolerance else r"^[1-9]\d{11}$"), F.lit(False))


def date_like(candidate: Column) -> Column:
    return F.substring(candidate, 1, 4).try_cast("int").between(2015, 2035) & F.substring(candidate, 5, 2).try_cast("int").between(1, 12)


def tight_400(text: Text) -> Column:
    """The first number right behind 400; it is trusted without a look-up."""
    found = F.concat(F.transform(_every(text, r"(?<!\d)400(?:[\s\-]{0,2})(\d(?:[\s\-]?\d){11})(?!\d)"), digits), _every(text, r"(?<!\d)400(\d{12})(?!\d)"))
    return F.get(F.filter(found, lambda x: ~disqualified(x)), 0)


def filename_key(name: Text) -> Column:
    base = F.regexp_extract(_col(name), r"[^/\\]*$", 0)
    return F.coalesce(F.get(_every(base, TWELVE), 0), F.regexp_replace(F.get(_every(base, r"(?<!\d)(\d{4}\s\d{4}\s\d{4})(?!\d)"), 0), " ", ""))


def any_text_keys(cell: Text) -> Column:
    runs = F.filter(F.transform(_every(cell, r"(\d[\d\-\s]{10,30}\d)"), digits), lambda x: F.length(x) == 12)
    return F.array_distinct(F.concat(_every(cell, r"\b(\d{12})\b"), runs))


def processed_name_key(name: Text) -> Column:
    stem = F.regexp_replace(F.regexp_extract(_col(name), r"[^/\\]*$", 0), r"\.[^.]*$", "")
    return F.nullif(F.regexp_extract(stem, r"^(\d{12})", 1), F.lit(""))


def is_batch_name(name: Text) -> Column:
    return _col(name).rlike(r"(?i)^(\d{12})(_\d+)?\.pdf$")


def aci_candidates(text: Text) -> Column:
    near = _every(text, r"(?i)(?<!\w)(?:A\s*[CGE6]\s*[I1L])\b[\D]{0,15}(\d(?:[\s\-]?\d){11})(?!\d)")
    labelled = _every(text, rf"(?i)(?<!\w)(?:A\s*[CGE6]\s*[I1L])\s*{NUMBER_WORD}\s*[:\-]?\s*{STRICT}")
    return _some(F.transform(_if(_aci(text), F.concat(near, labelled)), norm_digits))


def _aci(text: Text) -> Column:
    return _col(text).rlike(r"(?i)A\s*[CGE6]\s*[I1L]")


def line_blocks(text: Text, marked, before: int, after: int) -> Column:
    """Around each line that `marked` holds for, the lines before and after joined by spaces.

    Each line stands beside its neighbours (the same array, moved), so what is done for a line reads these few lines only.
    """
    none = F.lit(None).cast("string")

    def blocks(lines: Column) -> Column:
        moved = [F.concat(F.array_repeat(none, k), lines) for k in range(before, 0, -1)] + [F.slice(lines, k + 1, F.size(lines)) for k in range(after + 1)]
        # Rows past the last line have no line of their own, which `marked` does not hold for.
        rows = F.arrays_zip(*[x.alias(f"l{i}") for i, x in enumerate(moved)])
        kept = F.filter(rows, lambda r: F.coalesce(marked(r[f"l{before}"]), F.lit(False)))
        return F.transform(kept, lambda r: F.array_join(F.array(*[r[f"l{i}"] for i in range(len(moved))]), " "))

    # As the one element of an array, the lines are split once for all their uses.
    return F.flatten(F.transform(F.array(F.split(_col(text), r"\r\n|\n|\r")), blocks))


def _in_blocks(text: Text, marked, before: int = 1, after: int = 2) -> Column:
    return F.flatten(F.transform(line_blocks(text, marked, before, after), clean_candidates))


def carrier_candidates(text: Text) -> Column:
    near = F.transform(_every(text, rf"(?i)(?:FED[\s\-]*EX|FEDEX)[\D]{{0,30}}{STRICT}"), norm_digits)
    lines = _in_blocks(text, lambda x: F.regexp_replace(F.upper(x), r"\s+", "").contains("FEDEX") | F.upper(x).contains("FED-EX"))
    return _some(_if(_letters(text, "XFD"), F.concat(near, lines)))


def airway_candidates(text: Text) -> Column:
    near = F.transform(_every(text, r"(?i)(?<!\w)AIR\W*WAY\W*BIL{1,2}(?:\W*(?:NO|NUMBER|#))?\b[\D]{0,30}([A-Z0-9][A-Z0-9\-\s:/._]{10,30})"), norm_digits)

    def marked(x: Column) -> Column:
        bare = F.regexp_replace(F.upper(x), r"[^A-Z0-9]+", "")
        return (bare.contains("AIRWAY") & bare.contains("BILL")) | bare.contains("AWAYBILL")

    return _some(_if(_letters(text, "YWB"), F.concat(near, _in_blocks(text, marked))))


def label_candidates(text: Text) -> Column:
    """Numbers behind a label; these are of the high tier."""
    found = F.concat(
        _if(_holds(text, "AWB"), _every(text, r"(?i)(?<!\w)(HAWB|MAWB|AWB(?:\s*(?:NO|NUMBER))?)\b[\D]{0,15}(\d[\d\-\s]{10,24})", 2)),
        _if(_col(text).contains("400"), _every(text, r"(?<!\d)400(?:[\s\-]{0,2})(\d(?:[\s\-]?\d){11})(?!\d)")),
        _if(_col(text).contains("400"), _every(text, rf"(?i)(?<!\d)400\s*{NUMBER_WORD}\s*[:\-]?\s*{STRICT}")),
        _if(_aci(text), _every(text, r"(?i)(?<!\d)(?:A\s*[CGE6]\s*[I1L])(?:\D{0,15})(\d[\d\-\s]{10,24})(?!\d)")),
        _if(_letters(text, "KTR"), _every(text, r"(?i)(?<!\w)(?:TRACK(?:ING)?(?:\s*(?:NO|NUMBER|#))?|TRK(?:\s*(?:NO|NUMBER|#))?)\b[\D]{0,20}([A-Z0-9][A-Z0-9\-\s:/._]{10,30})")),
    )
    return _some(F.concat(F.transform(found, norm_digits), airway_candidates(text)))


def text_candidates(text: Text, aci: Column | None = None) -> Column:
    """Everything on a page that may be an identifier. aci: its aci_candidates, if they are at hand."""
    loose = F.transform(_if(_col(text).contains("400"), _every(text, r"(?<!\d)400[\s\-:]{0,6}([0-9][0-9\-\s]{10,20})(?!\d)")), lambda x: F.when(F.trim(x).rlike(rf"^{STRICT}$"), digits(x)))
    near_aci = F.transform(_if(_aci(text), _every(text, r"(?i)(?<!\d)(?:A\s*[CGE6]\s*[I1L])[\D]{0,15}([0-9][0-9\-\s]{10,22})(?!\d)")), norm_digits)
    return _some(F.concat(alnum_candidates(text), clean_candidates(text), loose, near_aci, aci_candidates(text) if aci is None else aci))


def _windows(run: Column) -> Column:
    return F.when(F.length(run) >= 12, F.transform(F.sequence(F.lit(1), F.length(run) - 11), lambda i: F.substring(run, i, F.lit(12))))


def windows_of_12(text: Text) -> Column:
    """All windows of 12 digits of longer runs, for a semi-join with the keys."""
    runs = F.transform(_every(text, r"(?<!\d)(\d[\d\-\s]{10,40}\d)(?!\d)"), digits)
    spans = F.transform(_every(F.upper(_col(text)), r"(?<![A-Z0-9])([A-Z0-9][A-Z0-9\-\s:/._]{8,36}[A-Z0-9])(?![A-Z0-9])"), lambda x: F.regexp_replace(x, r"[ \-:/._\t\r\n]", ""))
    spans = F.filter(spans, lambda x: (F.length(F.regexp_replace(x, "[^0-9]", "")) >= 8) & F.translate(x, CONFUSED, MEANT).rlike(r"^\d+$"))
    spans = F.transform(spans, lambda x: F.translate(x, CONFUSED, MEANT))
    return F.array_distinct(F.flatten(F.filter(F.transform(F.concat(runs, spans), _windows), lambda x: x.isNotNull())))


#: Context keywords without separators; one that holds another is found with it.
_BARE_KEYWORDS = {"".join(c for c in k if c.isalnum()) for k in CONTEXT_KEYWORDS}
_SHORTEST_KEYWORDS = sorted(k for k in _BARE_KEYWORDS if not any(x != k and x in k for x in _BARE_KEYWORDS))


def has_keyword(text: Column) -> Column:
    """Whether upper-case text holds a context keyword, as written or without separators; a text that has it as written has it without them too."""
    by_first = {c: "|".join(k[1:] for k in _SHORTEST_KEYWORDS if k[0] == c) for c in sorted({k[0] for k in _SHORTEST_KEYWORDS})}
    any_of = "|".join(f"{c}(?:{rest})" for c, rest in by_first.items())
    return F.regexp_replace(text, "[^A-Z0-9]+", "").rlike(any_of)


def _marked_line(line: Column) -> Column:
    """has_keyword of a line as it stands; a line shorter than every keyword is not looked at."""
    return (F.length(line) >= min(map(len, _SHORTEST_KEYWORDS))) & has_keyword(F.upper(line))


def keyword_adjacent(text: Text, candidates: Column) -> Column:
    """Those candidates that stand within CONTEXT_CHARS of a keyword, or on a line next to a keyword's.

    One scan each gives all numbers of twelve digits, what stands before and what stands behind them, within reach; keywords are
    looked for in these surroundings, so the work grows with the text and not with its numbers.
    """
    s = _col(text)
    upper = F.upper(s)
    # What stands before a number stands behind it in the text read backwards; looking back over a stretch of any length is slow.
    surroundings = lambda x: _every(x, rf"{TWELVE}(?=([\s\S]{{0,{CONTEXT_CHARS}}}))", 2)
    before, behind = F.transform(F.reverse(surroundings(F.reverse(upper))), F.reverse), surroundings(upper)
    spans = F.arrays_zip(_every(upper, TWELVE).alias("number"), before.alias("before"), behind.alias("behind"))
    close = F.transform(F.filter(spans, lambda x: has_keyword(F.concat(x["before"], x["number"], x["behind"]))), lambda x: x["number"])
    around = F.flatten(F.transform(line_blocks(text, _marked_line, 1, 1), lambda b: _every(b, TWELVE)))
    none = F.array().cast("array<string>")
    # A text without any keyword has none in a part of it.
    return F.when(s.rlike(TWELVE) & has_keyword(upper), F.array_intersect(candidates, F.concat(around, close))).otherwise(none)


def near_keyword_candidates(text: Text, before: int = 1, after: int = 3) -> Column:
    """Strict numbers in lines around a keyword's line, or within CONTEXT_CHARS of a keyword."""
    relaxed = r"(?i)AIR\w{0,6}WAY\w{0,6}BIL{1,2}|WAY\w{0,6}BIL{1,2}|TRACK\w{0,10}(NO|NUM|NUMBER)?|\bAWB\b|BIL{1,2}\w{0,8}(NO|NUM|NUMBER)"
    marked = lambda x: _marked_line(x) | x.rlike(relaxed)
    around = _in_blocks(text, marked, before, after)
    return F.array_distinct(F.concat(around, keyword_adjacent(text, clean_candidates(text))))
