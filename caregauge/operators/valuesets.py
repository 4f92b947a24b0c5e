"""Value sets: normalising the code table and tagging coded claims with it.

A measure lists the rules it needs in a ``CodeBook``. Tagging then reads the
claims once: every row gets a bit mask of the rules its codes satisfy, instead
of one join per value set and code column. The lookup side is the filtered code
table; no broadcast is forced, so Spark broadcasts it when its size allows and
shuffles (with skew handling) when it does not.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caregauge.functions import code_columns, icd_version, strip_dots
from caregauge.sources.scratch import stored

# Code systems and the claim column they are matched on.
CHANNEL_SYSTEMS = {
    "hcpcs": ("CPT", "HCPCS"),
    "icdproc": ("ICD9PCS", "ICD10PCS"),
    "icddiag": ("ICD9CM", "ICD10CM"),
    "revcode": ("UBREV",),
    "billtype": ("UBTOB",),
}

#: Tags that one mask word holds.
WORD_BITS = 62
#: Copies of a frequent code's lookup row.
COPIES = 64
MASK = "tags"
ORDINAL = "icd_ordinal"


def normalise_value_sets(reference: DataFrame, style: str = "icd") -> DataFrame:
    """Strip dots from ``code`` and add ``icdversion`` in the given style."""
    return reference.withColumns(
        {"code": strip_dots("code"), "icdversion": icd_version("code_system", style)}
    )


def split_value_sets(reference: DataFrame) -> Mapping[str, DataFrame]:
    """One lookup per claim column: value set name, code, and ICD version if any."""
    normal = normalise_value_sets(reference, "padded")
    lookups = {}
    for channel, systems in CHANNEL_SYSTEMS.items():
        columns = ["value_set_name", F.col("code").alias(channel)]
        if channel.startswith("icd"):
            columns.append("icdversion")
        lookups[channel] = normal.where(F.col("code_system").isin(*systems)).select(*columns)
    return lookups


def value_set_coverage(reference: DataFrame, required: Iterable[str]) -> DataFrame:
    """Number of codes of every required value set; zero when it is missing."""
    names = sorted(set(required))
    wanted = reference.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in names])).alias("value_set_name")
    )
    found = (
        reference.where(F.col("value_set_name").isin(names))
        .groupBy("value_set_name")
        .agg(F.count("*").alias("n_codes"))
    )
    return wanted.join(found, "value_set_name", "left").select(
        "value_set_name", F.coalesce("n_codes", F.lit(0)).cast("long").alias("n_codes")
    )


def require_one_code_system(reference: DataFrame, value_set: str) -> None:
    """Fail when a value set mixes code systems or has none."""
    require(reference, one_system=(value_set,))


def require_value_sets(reference: DataFrame, required: Iterable[str]) -> None:
    """Fail when a required value set has no code."""
    require(reference, present=required)


def unaccounted_code_systems(
    reference: DataFrame, accounted: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Code systems of value sets that no rule would ever look at."""
    covered = reduce(
        lambda a, b: a | b,
        [
            (F.col("value_set_name") == name) & F.col("code_system").isin(*systems)
            for name, systems in accounted.items()
        ],
    )
    return (
        reference.where(F.col("value_set_name").isin(*accounted) & ~covered)
        .select("value_set_name", "code_system")
        .distinct()
    )


def require_code_systems(
    reference: DataFrame, accounted: Mapping[str, Sequence[str]]
) -> None:
    """Fail when a value set uses a code system that would be ignored."""
    require(reference, accounted=accounted)


def require(
    reference: DataFrame,
    present: Iterable[str] = (),
    one_system: Iterable[str] = (),
    accounted: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """All of these checks from one aggregate over the code table.

    ``present`` must have codes, ``one_system`` must use one code system each, and
    ``accounted`` must use no other systems than those listed. At most one row for each
    named value set and code system comes back.
    """
    present, one_system, accounted = set(present), set(one_system), dict(accounted or {})
    names = sorted(present | one_system | set(accounted))
    rows = (
        reference.where(F.col("value_set_name").isin(names))
        .select("value_set_name", *[c for c in ("code_system",) if one_system or accounted])
        .distinct()
        .collect()
    )
    systems: dict[str, set] = {}
    for row in rows:
        systems.setdefault(row[0], set()).update(row[1:])
    if missing := sorted(present - set(systems)):
        raise ValueError(f"value sets without codes: {missing}")
    for name, known in accounted.items():
        ignored = systems.get(name, set()) - {None} - set(known)
        if ignored:
            raise ValueError(f"code systems not accounted for: {sorted((name, x) for x in ignored)}")
    for name in sorted(one_system):
        if len(systems.get(name, ())) != 1:
            raise ValueError(f"value set {name!r} must use one code system")


def unpivot_codes(claims: DataFrame, stem: str, keep: Sequence[str]) -> DataFrame:
    """One row per filled code column: ``keep``, ``ordinal`` (from 1), ``code``."""
    codes = [
        F.struct(F.lit(i).alias("ordinal"), F.col(name).alias("code"))
        for i, name in enumerate(code_columns(claims, stem), start=1)
    ]
    return claims.select(*keep, F.inline(F.array(*codes))).where(F.col("code").isNotNull())


@dataclass(frozen=True)
class CodeRule:
    """``tag`` holds for a claim row whose ``channel`` has a code of the value sets.

    ``systems`` restricts the code systems (none: any). ICD channels also compare
    the ICD version unless ``versioned`` is off. ``pattern`` selects value sets by
    regular expression instead of by name.
    """

    tag: str
    channel: str
    value_sets: tuple[str, ...] = ()
    systems: tuple[str, ...] | None = None
    versioned: bool = True
    pattern: str | None = None
    principal: bool = False

    @property
    def is_icd(self) -> bool:
        return self.channel.startswith("icd")

    def selects(self) -> str:
        """SQL condition on the code table."""
        if self.pattern:
            chosen = f"value_set_name RLIKE {_texts(self.pattern)}"
        else:
            chosen = f"value_set_name IN ({_texts(*self.value_sets)})"
        if self.systems is not None:
            chosen += f" AND code_system IN ({_texts(*self.systems)})"
        if self.is_icd and self.versioned:
            chosen += " AND icdversion IS NOT NULL"
        return chosen

    def version(self) -> str:
        return "icdversion" if self.is_icd and self.versioned else "''"


@dataclass(frozen=True)
class IcdSlot:
    """One ICD column of a claim row and how its code is matched."""

    channel: str
    column: str
    version: str
    ordinal: int


def _texts(*values: str) -> str:
    """SQL string literals."""
    escaped = (value.replace("\\", "\\\\").replace("'", "\\'") for value in values)
    return ", ".join(f"'{value}'" for value in escaped)


def _word(number: int) -> str:
    return MASK if number == 0 else f"{MASK}_{number + 1}"


@dataclass(frozen=True)
class Lookup:
    """How claim rows are matched: ``codes`` (channel, version, code, mask words), and what to match."""

    codes: DataFrame
    words: tuple[str, ...]
    row_channels: tuple[str, ...]
    icd_channels: tuple[tuple[str, bool], ...]  # (channel, versioned)
    principal: Mapping[str, int]  # by word: bits that count in first position only

    def tagged(self, claims: DataFrame, keep: Sequence[str], frequent: Sequence[str] = ()) -> DataFrame:
        """``keep``, the words and the ICD position of every claim row and ICD code.

        Null codes match nothing and must not meet in one partition of a shuffled join:
        their key is a hash of the row. Codes of ``frequent`` meet copies of their lookup
        row, each of which takes a share of the claims.
        """
        slots = [
            IcdSlot(channel, name, "_version" if versioned else "''", ordinal)
            for channel, versioned in self.icd_channels
            for ordinal, name in enumerate(code_columns(claims, channel), start=1)
        ]
        hashed = dict.fromkeys((*keep, *self.row_channels, *(slot.column for slot in slots)))
        spread = f"xxhash64({', '.join(hashed)})"

        def salted(side: DataFrame, code: str) -> DataFrame:
            copies = f"sequence(0, CASE WHEN {code} IN ({_texts(*frequent)}) THEN {COPIES - 1} ELSE 0 END)"
            return side.selectExpr("*", f"explode({copies}) AS _salt")

        def salt(code: str, row: str) -> str:
            return f"CASE WHEN {code} IN ({_texts(*frequent)}) THEN int(pmod({row}, {COPIES})) ELSE 0 END AS _salt"

        tagged = claims
        if self.row_channels:
            tagged = tagged.selectExpr("*", f"{spread} AS _row")
        for channel in self.row_channels:
            side = self.codes.where(f"channel = '{channel}'").selectExpr(
                "code AS _code", *[f"{word} AS _{channel}_{word}" for word in self.words]
            )
            key = f"coalesce({channel}, concat('-', _row)) AS _code"
            on = ["_code"]
            tagged = tagged.selectExpr("*", key, *([salt(channel, "_row")] if frequent else []))
            if frequent:
                side, on = salted(side, "_code"), ["_code", "_salt"]
            tagged = tagged.join(side, on, "left").drop(*on)
        row_words = {
            word: " | ".join(f"coalesce(_{channel}_{word}, 0L)" for channel in self.row_channels) or "0L"
            for word in self.words
        }
        if not slots:
            return tagged.selectExpr(*keep, *[f"{mask} AS {word}" for word, mask in row_words.items()], f"0 AS {ORDINAL}")
        # Slot 0 is the row itself; each further slot is one ICD column, matched on (channel,
        # version, code) and kept if it matches. Slot 0 matches nothing: its code is a hash that spreads these
        # rows evenly, should the join be shuffled.
        columns = ", ".join(slot.column for slot in slots)
        codes = tagged.selectExpr(
            *keep,
            "icdversion AS _version",
            *[f"{mask} AS _row_{word}" for word, mask in row_words.items()],
            *([f"{spread} AS _row"] if frequent else []),
            f"posexplode(array(concat('-', {spread}), {columns})) AS (_slot, code)",
        ).where("code IS NOT NULL")

        def per_slot(values: Iterable[str], otherwise: str) -> str:
            branches = (f"WHEN {i} THEN {value}" for i, value in enumerate(values, start=1))
            return f"CASE _slot {' '.join(branches)} ELSE {otherwise} END"

        keyed = codes.selectExpr(
            *keep,
            *[f"_row_{word}" for word in self.words],
            "code",
            per_slot((f"'{slot.channel}'" for slot in slots), "'-'") + " AS channel",
            per_slot((slot.version for slot in slots), "'-'") + " AS version",
            per_slot((str(slot.ordinal) for slot in slots), "0") + f" AS {ORDINAL}",
            *([salt("code", "_row")] if frequent else []),
        )
        side = self.codes.where("channel LIKE 'icd%'").selectExpr(
            "channel", "version", "code", *[f"{word} AS _code_{word}" for word in self.words]
        )
        on = ["channel", "version", "code"]
        if frequent:
            side, on = salted(side, "code"), [*on, "_salt"]

        def of_code(word: str) -> str:
            mask = f"coalesce(_code_{word}, 0L)"
            if bits := self.principal.get(word):
                mask = f"(CASE WHEN {ORDINAL} = 1 THEN {mask} ELSE {mask} & ~{bits}L END)"
            return f"_row_{word} | {mask} AS {word}"

        met = f"channel = '-' OR _code_{self.words[0]} IS NOT NULL"
        return (
            keyed.join(side, on, "left").where(met).selectExpr(*keep, *map(of_code, self.words), ORDINAL)
        )


class CodeBook:
    """The code rules of a measure, each tag being one bit of a mask of as many words as needed.

    Its many small expressions are written as SQL text: each one then costs a
    single call into the JVM while the plan is built.
    """

    def __init__(self, *rules: CodeRule, version: str = "icd") -> None:
        self.rules = rules
        self.version = version
        tags = list(dict.fromkeys(rule.tag for rule in rules))
        self._place = {tag: (_word(i // WORD_BITS), 1 << i % WORD_BITS) for i, tag in enumerate(tags)}
        self.words = tuple(dict.fromkeys(word for word, _ in self._place.values()))
        self.width = min(len(tags), WORD_BITS)

    def sql(self, tag: str) -> str:
        """SQL condition: the tagged row satisfies ``tag``."""
        word, bit = self._place[tag]
        return f"({word} & {bit}L) != 0"

    def any_sql(self) -> str:
        """SQL condition: the tagged row satisfies some rule."""
        return "(" + " OR ".join(f"{word} != 0" for word in self.words) + ")"

    def has(self, tag: str) -> Column:
        """The tagged row satisfies ``tag``."""
        return F.expr(self.sql(tag))

    def merged(self) -> list[Column]:
        """Aggregates: the tags of all rows of a group."""
        return [F.bit_or(word).alias(word) for word in self.words]

    def lookup(self, reference: DataFrame) -> DataFrame:
        """(channel, version, code) → mask words, one row each."""

        def entry(rule: CodeRule) -> str:
            word, bit = self._place[rule.tag]
            words = ", ".join(f"'{w}', {bit if w == word else 0}L" for w in self.words)
            return (
                f"CASE WHEN {rule.selects()} THEN named_struct('channel', '{rule.channel}', "
                f"'version', {rule.version()}, {words}) END"
            )

        # The condition outside of the CASE reaches the scan of the code table.
        used = " OR ".join(dict.fromkeys(f"({rule.selects()})" for rule in self.rules))
        return (
            normalise_value_sets(reference, self.version)
            .where(used)
            .selectExpr("code", f"inline(array_compact(array({', '.join(map(entry, self.rules))})))")
            .groupBy("channel", "version", "code")
            .agg(*self.merged())
        )

    def matching(self, reference: DataFrame) -> Lookup:
        principal: dict[str, int] = {}
        for tag in dict.fromkeys(rule.tag for rule in self.rules if rule.principal):
            word, bit = self._place[tag]
            principal[word] = principal.get(word, 0) | bit
        return Lookup(
            self.lookup(reference),
            self.words,
            tuple(dict.fromkeys(r.channel for r in self.rules if not r.is_icd)),
            tuple(dict.fromkeys((r.channel, r.versioned) for r in self.rules if r.is_icd)),
            principal,
        )

    def tag(
        self,
        claims: DataFrame,
        reference: DataFrame,
        keep: Sequence[str],
        also: Column | None = None,
        frequent: Sequence[str] = (),
    ) -> DataFrame:
        """Claim rows that satisfy a rule: ``keep``, the mask words and the ICD position.

        A row is repeated for each of its ICD codes that matches (the bits of its other
        columns ride along, so conditions across columns of one row stay testable), plus
        once without any ICD code (position 0). ``also`` keeps further rows. ``frequent``:
        codes of so many claims that one task should not match them all (see
        ``frequent_codes``); they only matter where the code table is too large to broadcast.
        """
        wanted = F.expr(self.any_sql())
        if also is not None:
            wanted = wanted | also
        return self.matching(reference).tagged(claims, keep, frequent).where(wanted)


def frequent_codes(claims: DataFrame, channels: Sequence[str], share: float = 0.01) -> list[str]:
    """Codes that stand in at least ``share`` of the rows of a column, from one aggregate.

    ``channels``: columns, or stems of numbered ones. At most 1 / ``share`` codes of each
    column come back.
    """
    columns = [name for c in channels for name in ([c] if c in claims.columns else code_columns(claims, c))]
    pairs = ", ".join(f"named_struct('at', {i}, 'code', {name})" for i, name in enumerate(columns))
    counted = claims.selectExpr(f"inline(array({pairs}))").groupBy("at", "code").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("at"))
    rows = counted.withColumn("total", total).where((F.col("n") >= share * F.col("total")) & F.col("code").isNotNull())
    return sorted({row["code"] for row in rows.select("code").collect()})


@dataclass(frozen=True, eq=False)
class ClaimNeed:
    """What a measure reads of the claims: lines that satisfy ``rows`` (none: all) and a rule of
    ``book`` or else ``also``; ``columns`` are carried and must hold what both conditions read."""

    book: CodeBook
    codes: DataFrame
    columns: tuple[str, ...]
    rows: Column | None = None
    also: Column | None = None

    def tag(self, claims: DataFrame) -> DataFrame:
        """These rows from a pass of their own."""
        claims = claims if self.rows is None else claims.where(self.rows)
        return self.book.tag(claims, self.codes, self.columns, self.also)


class SharedTags:
    """Claims tagged once for several needs, and each need's rows of them.

    The rules of all books are one lookup. Every book has a stretch of bits in some shared word
    (books of several words have words of their own). A row says which books want it, and holds of the
    columns and bits only what these books read: the rest would take as much disk again.
    """

    def __init__(self, claims: DataFrame, needs: Sequence[ClaimNeed], frequent: Sequence[str] = ()) -> None:
        self._at: dict[CodeBook, list[tuple[int, int]]] = {}  # book → (shared word, first bit) of its words
        used: list[int] = []
        firsts = {need.book: need for need in needs}
        for book in firsts:
            places = []
            for k in range(len(book.words)):
                bits = book.width if len(book.words) == 1 else WORD_BITS
                at = next((i for i, n in enumerate(used) if n + bits <= WORD_BITS), len(used))
                used += [0] * (at == len(used))
                places.append((at, used[at]))
                used[at] += bits
            self._at[book] = places
        words = tuple(f"_shared_{i}" for i in range(len(used)))
        lookups, principal = [], dict.fromkeys(words, 0)
        row_channels: dict[str, None] = {}
        icd_channels: dict[tuple[str, bool], None] = {}
        for book, need in firsts.items():
            own = book.matching(need.codes)
            row_channels |= dict.fromkeys(own.row_channels)
            icd_channels |= dict.fromkeys(own.icd_channels)
            parts: dict[int, str] = {}
            for (at, low), word in zip(self._at[book], own.words, strict=True):
                parts[at] = f"shiftleft({word}, {low})"
                principal[words[at]] |= own.principal.get(word, 0) << low
            lookups.append(
                own.codes.selectExpr(
                    "channel", "version", "code", *[f"{parts.get(i, '0L')} AS {w}" for i, w in enumerate(words)]
                )
            )
        codes = (
            reduce(DataFrame.unionByName, lookups)
            .groupBy("channel", "version", "code")
            .agg(*[F.bit_or(w).alias(w) for w in words])
        )
        codes = stored(codes, "shared-codes")  # read by a join for each code column
        lookup = Lookup(codes, words, tuple(row_channels), tuple(icd_channels), principal)
        columns = [c for c in dict.fromkeys(c for need in needs for c in need.columns) if c in claims.columns]
        read = [need.rows for need in needs]
        if all(condition is not None for condition in read):
            claims = claims.where(reduce(or_, read))
        self._words = words
        tagged = lookup.tagged(claims, columns, frequent)
        self._number = {book: i for i, book in enumerate(firsts)}
        flags = [
            F.when(reduce(or_, [self._wanted(need) for need in needs if need.book is book]), 1 << i % WORD_BITS).otherwise(0)
            for book, i in self._number.items()
        ]
        names = [f"_for_{k}" for k in range(-(-len(flags) // WORD_BITS))]
        marked = tagged.withColumns(
            {
                name: reduce(Column.bitwiseOR, flags[k * WORD_BITS : (k + 1) * WORD_BITS]).cast("long")
                for k, name in enumerate(names)
            }
        )
        # As a condition it would be worked out twice, and with what follows in one method that is too
        # long to be compiled: a step with a lambda is not generated into its neighbours' code.
        some = " OR ".join(f"x.{name} != 0" for name in names)
        marked = marked.selectExpr("*", f"explode(filter(array(struct({', '.join(names)})), x -> {some})) AS _wanted")
        marked = marked.drop(*names).selectExpr("*", *[f"_wanted.{name} AS {name}" for name in names])
        kept = [self._column({n.book for n in needs if c in n.columns}, c) for c in columns]
        self._rows = marked.selectExpr(*kept, *map(self._bits, words), ORDINAL, *names)

    def _flagged(self, book: CodeBook) -> str:
        """SQL condition: some need of the book wants the row."""
        i = self._number[book]
        return f"(_for_{i // WORD_BITS} & {1 << i % WORD_BITS}L) != 0"

    def _column(self, books: set[CodeBook], name: str) -> str:
        """SQL of a column that ``books`` read."""
        if len(books) == len(self._number):
            return name
        return f"CASE WHEN {' OR '.join(self._flagged(b) for b in self._number if b in books)} THEN {name} END AS {name}"

    def _bits(self, word: str) -> str:
        """SQL of a shared word, without the bits of books that don't want the row."""
        parts = []
        for book, places in self._at.items():
            bits = book.width if len(places) == 1 else WORD_BITS
            parts += [
                f"CASE WHEN {self._flagged(book)} THEN {word} & {(1 << bits) - 1 << low}L ELSE 0L END"
                for at, low in places
                if self._words[at] == word
            ]
        return f"{' | '.join(parts)} AS {word}"

    def _own(self, book: CodeBook) -> dict[str, str]:
        """SQL of the book's words over the shared ones."""
        if len(book.words) > 1:
            return {w: self._words[at] for w, (at, _) in zip(book.words, self._at[book], strict=True)}
        at, low = self._at[book][0]
        return {book.words[0]: f"(shiftrightunsigned({self._words[at]}, {low}) & {(1 << book.width) - 1}L)"}

    def _wanted(self, need: ClaimNeed) -> Column:
        wanted = F.expr(" OR ".join(f"{sql} != 0" for sql in self._own(need.book).values()))
        if need.also is not None:
            wanted = wanted | need.also
        return wanted if need.rows is None else wanted & need.rows

    def stored(self) -> SharedTags:
        """Written once to the shared scratch folder; every need then reads it there."""
        self._rows = stored(self._rows, "tagged-claims")
        return self

    def rows(self, need: ClaimNeed) -> DataFrame:
        """As ``need.tag``: its columns, its book's words and the ICD position."""
        own = [f"{sql} AS {word}" for word, sql in self._own(need.book).items()]
        rows = self._rows.where(self._flagged(need.book)).where(self._wanted(need))
        return rows.selectExpr(*need.columns, *own, ORDINAL)


def claim_value_sets(
    claims: DataFrame,
    reference: DataFrame,
    value_sets: Sequence[str],
    key: Sequence[str] = ("member_id", "claimid"),
) -> DataFrame:
    """Sorted names of the value sets each claim touches, over all code columns."""
    wanted = sorted(set(value_sets))
    book = CodeBook(
        *[
            CodeRule(name, channel, (name,), systems)
            for name in wanted
            for channel, systems in CHANNEL_SYSTEMS.items()
        ],
        version="padded",
    )
    found = book.tag(claims, reference, list(key)).groupBy(*key).agg(*book.merged())
    names = ", ".join(f"CASE WHEN {book.sql(name)} THEN {_texts(name)} END" for name in wanted)
    return found.selectExpr(*key, f"array_compact(array({names})) AS value_set_names")


def codes_unique_to(reference: DataFrame, wanted: str, other: str) -> DataFrame:
    """Rows of value set ``wanted`` whose code occurs once in both sets together."""
    both = reference.where(F.col("value_set_name").isin(wanted, other))
    once = both.groupBy("code").agg(F.count("*").alias("_n")).where("_n < 2").select("code")
    return both.where(F.col("value_set_name") == wanted).join(once, "code", "left_semi")
