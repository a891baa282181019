"""Names of places in one form, and the forms under which they are looked up."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of countries and the one that each stands for.
COUNTRIES = {
    "united state of america": "united states of america", "united states": "united states of america", "united states of america": "united states of america", "usa": "united states of america", "us": "united states of america",
    "u s a": "united states of america", "u s": "united states of america", "uk": "united kingdom", "great britain": "united kingdom", "england": "united kingdom", "czech republic": "czechia", "ivory coast": "cote divoire",
    "burma": "myanmar", "south korea": "south korea", "republic of korea": "south korea", "north korea": "north korea", "russian federation": "russia", "democratic republic of the congo": "dem rep congo",
}
#: Postal letters of states and territories.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois",
    "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana",
    "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "DC": "District of Columbia", "PR": "Puerto Rico", "GU": "Guam", "VI": "United States Virgin Islands", "AS": "American Samoa", "MP": "Northern Mariana Islands",
}
#: Letters with marks and the letters under them, from the rule of canonical decomposition.
_MARKED = {chr(c): d[0] for c in range(0xC0, 0x250) if len(d := unicodedata.normalize("NFD", chr(c))) > 1 and all(unicodedata.combining(x) for x in d[1:])}


def place_name(text: Column) -> Column:
    """A place's name without marks, case, some punctuation and a leading "the", with "and" for "&"; null is
    empty."""
    bare = F.translate(F.coalesce(text, F.lit("")), "".join(_MARKED), "".join(_MARKED.values()))
    bare = F.lower(F.regexp_replace(bare, "[\\u0300-\\u036f]", ""))
    bare = F.replace(F.regexp_replace(bare, "[.,'’`]", ""), F.lit("&"), F.lit("and"))
    return F.regexp_replace(F.trim(F.regexp_replace(bare, r"\s+", " ")), "^the ", "")


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def place_keys(field: Column, text: Column) -> Column:
    """The names under which a place is looked up: a country by what it stands for; a state or territory by
    its name and, for postal letters, by what they stand for; others by their name. Empty ones go."""
    name = place_name(text)
    country = F.coalesce(F.try_element_at(_lookup(COUNTRIES), name), name)
    spelled = F.try_element_at(_lookup({k: v.lower() for k, v in STATES.items()}), F.upper(F.trim(F.coalesce(text, F.lit("")))))
    keys = F.when(field == "country", F.array(country)).when(field == "state", F.array(name, spelled)).otherwise(F.array(name))
    return F.filter(keys, lambda k: k.isNotNull() & (k != ""))
