"""Rule-based topic of a keyword (first matching rule wins, default "9. Other").

Matching is a case-sensitive, unanchored regex search (``rlike``), like ``grepl``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col

# ---- fixed values: topic labels and their patterns, in rule order ------------------
# (D8: two labels start with "5."; D9: "States (US)" is a regex group and so matches
#  the text "States US", kept as written.)
TOPIC_RULES: list[tuple[str, str]] = [
    ("1. Politics",
     "Politics|Trump|Republ|Democr|Government|Election|Presidential|Senate|House of Rep|"
     "Law and Legislation"),
    ("2. Economy",
     "Income|Infrastructure|Economic|Economy|Trade|Tariffs|Labor and Jobs|"
     "Wages and Salaries|Real Estate|Regulation"),
    ("3. National",
     "State Legislatures|States (US)|Drug Abuse and Traffic|Florida|"
     "Federal Bureau of Investigation|Mueller, Robert S III|News and News Media|Firearms|"
     "Zuckerberg|Gun|Shooting|United States|Social Media|Education|"
     "Colleges and Universities|Discrimination|#MeToo|Blacks|Sexual|Ethnicity|"
     "Demonstration|Sex Crimes|Justice Department|Executive Changes|California|"
     "States (US)|Health Insurance|Murders|Ethics"),
    ("4. International",
     "Palestinians|Terrorism|Espionage|International|Immigration|Russia|China|Iran|"
     "North Korea|Kim Jong-un|Great Britain|South Korea|Syria|Olympic|Israel|Vietnam|Canada"),
    ("5. Science and Technology",
     "Research|Global Warming|Science|Computer|Apple|PC|Data-Mining|Database|Facebook|"
     "Analy|Environmental"),
    ("5. Entertainment",
     "Actors and Actresses|Music|Fallon|Colbert|Television|Entertainment|Theater|"
     "Theatre|Movies|Art|Books"),
    ("6. Food", "Restaurants|Food|Cooking|Chef"),
    ("7. Lifestyle",
     "Writing and Writers|Exercise|Women and Girls|Men and Boys|Weight|Nutrition|Fashion|"
     "Parenting|Vacations|Photography|Crossword|Children|Family"),
    ("8. Local", "Manhattan|NYC|New York City|New York Times|New York State"),
]
DEFAULT_TOPIC = "9. Other"
# -------------------------------------------------------------------------------------


def topic_of(c: str | Column, rules: list[tuple[str, str]] = TOPIC_RULES,
             default: str = DEFAULT_TOPIC) -> Column:
    """``when(rlike).when(rlike)...otherwise(default)``; a null keyword gets the
    default, as ``grepl(NA)`` is FALSE."""
    x = col(c)
    expr = None
    for label, pattern in rules:
        cond = F.coalesce(x.rlike(pattern), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def topic_sql(x: str, rules: list[tuple[str, str]] = TOPIC_RULES,
              default: str = DEFAULT_TOPIC) -> str:
    """The same rule list as a DuckDB ``CASE`` (used by the oracle SQL)."""
    parts = [f"WHEN coalesce(regexp_matches({x}, '{p.replace(chr(39), chr(39) * 2)}'), false) "
             f"THEN '{label}'" for label, p in rules]
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"
