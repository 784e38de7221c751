"""Names, ids, pick names and labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Generational suffixes dropped from names, and nickname -> formal first name.
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")
FORMAL_FIRST_NAMES = {
    "kenny": "kenneth", "josh": "joshua", "mike": "michael", "chris": "christopher",
    "nick": "nicholas", "matt": "matthew", "dave": "david", "rob": "robert",
    "will": "william", "tony": "anthony", "sam": "samuel", "joe": "joseph",
    "dan": "daniel", "steve": "steven", "andy": "andrew", "tom": "thomas",
    "jim": "james", "alex": "alexander",
}

# The formats of ids and pick names.
PLAYER_ID_FORMAT = r"^\d{2}-\d{7}$"
PICK_SLOT_FORMAT = r"^(\d{4}) Pick \d+\.\d+$"
PICK_ROUND_FORMAT = r"^(\d{4}) (\d)(?:st|nd|rd|th)(?: \((Early|Mid|Late)\))?$"
PICK_TIER_FIRST_FORMAT = r"^(\d{4}) (Early|Mid|Late) (\d)(?:st|nd|rd|th)$"


def normalize_name(name: Column) -> Column:
    """Lower case, no punctuation, no generational suffix, formal first name; null becomes ''."""
    letters = F.regexp_replace(F.lower(name), r"(?U)[^a-z0-9\s]", "")
    words = F.filter(
        F.split(F.regexp_replace(letters, r"(?U)\s+", " "), " "),
        lambda w: (w != "") & ~w.isin(*NAME_SUFFIXES),
    )
    formal = F.create_map(*[F.lit(x) for x in chain.from_iterable(FORMAL_FIRST_NAMES.items())])

    def joined(w: Column) -> Column:
        first = F.get(w, F.lit(0))
        head = F.coalesce(F.try_element_at(formal, first), first)
        return F.array_join(F.concat(F.array(head), F.slice(w, 2, F.greatest(F.size(w), F.lit(1)))), " ")

    # Bound to a lambda variable, the word list is computed once per row instead of once per use.
    whole = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, joined(w))), F.lit(0))
    return F.coalesce(whole, F.lit(""))


def lenient_number(text: Column, kind: str = "double") -> Column:
    """Number or null, never an error; NaN counts as missing. Whole numbers keep all their digits."""
    number = text.try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if kind == "double" else F.coalesce(text.try_cast(kind), number.try_cast(kind))


def normalize_id(raw: Column) -> Column:
    """'9221.0' and '9221' become the same id; anything that is not a number is kept."""
    whole = F.coalesce(raw.try_cast("bigint"), raw.try_cast("double").try_cast("bigint")).cast("string")
    return F.coalesce(whole, raw)


def has_player_id_format(value: Column) -> Column:
    return value.rlike(PLAYER_ID_FORMAT)


def _group(text: Column, pattern: str, index: int) -> Column:
    """A regex group, null when the group or the whole match is absent."""
    return F.nullif(F.regexp_extract(text, pattern, index), F.lit(""))


def _pick(year, round_, tier, kind) -> Column:
    return F.struct(
        F.lit(year).cast("int").alias("year"),
        F.lit(round_).cast("int").alias("round"),
        F.lit(tier).cast("string").alias("tier"),
        F.lit(kind).cast("string").alias("kind"),
    )


def parse_pick_name(name: Column, grammar: str) -> Column:
    """struct<year, round, tier, kind>, or null when the text is no pick name.

    ``grammar`` is 'round_first' ("2027 1st (Early)", "2028 1st", "2026 Pick 1.01") or
    'tier_first' ("2027 Early 1st"). ``kind`` is tier, aggregate or slot.
    """
    if grammar == "round_first":
        tier = _group(name, PICK_ROUND_FORMAT, 3)
        slot = _pick(_group(name, PICK_SLOT_FORMAT, 1), None, None, "slot")
        priced = _pick(
            _group(name, PICK_ROUND_FORMAT, 1),
            _group(name, PICK_ROUND_FORMAT, 2),
            tier,
            F.when(tier.isNull(), "aggregate").otherwise("tier"),
        )
        return F.when(name.rlike(PICK_SLOT_FORMAT), slot).when(name.rlike(PICK_ROUND_FORMAT), priced)
    if grammar == "tier_first":
        priced = _pick(
            _group(name, PICK_TIER_FIRST_FORMAT, 1),
            _group(name, PICK_TIER_FIRST_FORMAT, 3),
            _group(name, PICK_TIER_FIRST_FORMAT, 2),
            "tier",
        )
        return F.when(name.rlike(PICK_TIER_FIRST_FORMAT), priced)
    raise ValueError(f"unknown grammar {grammar!r}")


def pick_asset_id(fmt: Column, team_size: Column, year: Column, round_: Column, tier: Column) -> Column:
    return F.concat_ws("-", F.lit("PICK"), fmt, team_size.cast("string"), year.cast("string"),
                       round_.cast("string"), tier)


def pick_title(year: Column, round_: Column, tier: Column) -> Column:
    return F.format_string("%d Round %d (%s)", year, round_, tier)


def asset_label(asset_type: Column, name: Column, position: Column, team: Column) -> Column:
    """'name (pick)' for picks, 'name (position, team)' for players; no team reads FA."""
    shown_team = F.coalesce(F.nullif(team, F.lit("")), F.lit("FA"))
    return F.when(asset_type == "pick", F.concat(name, F.lit(" (pick)"))).otherwise(
        F.concat(name, F.lit(" ("), position, F.lit(", "), shown_team, F.lit(")"))
    )


def display_value(value: Column) -> Column:
    """Whole number with thousands separators, '--' for null."""
    return F.coalesce(F.format_number(F.bround(value, 0), 0), F.lit("--"))
