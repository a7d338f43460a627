"""A corpus in which every rule has something to do.

The synthetic documents hold none of the patterns that the rules look for, so a passage that
does is added to each text, chosen by doc_id; the same expression exists in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGES = (
    "l’étude ‘du‛ droit` 1870–1871 — fin − 3me PARTIE lr Janvier I874 2™ et 5ème, 1ère 4lre XIXme 7mo 8mc 6em 2ME 2do 9ieme",
    "19 Août 1875 Aoùt aoùt  MM Asser pp 438 n° 59 St-Pétersbourg etc vol 3 art 5 cf Dr Mme Mlles ibid op cit t IV Mars Décembre",
    'T. Il, pp. 179 T. Vit, 1875 Vil VIL T.VI, pp.582 et ss, ou et ss; puis et ss. pp.118 in-8" 670 OEUVRE Oeuvre oeuvre coeur voeux\n\n"5 fin\n\n2" suite',
    "nous;justifier 10:30 venir.La Belgique , fin ! ok : oui  double   triple insécable membres,les T. II et coeurs 3eme",
    "cafe\u0301 mot\u200bmot \ufeffIntroduction\u0007 gauche\tdroite 1er 1re 3e fin",
)


def noisy(text: Column, doc_id: Column) -> Column:
    passage = F.get(F.array(*map(F.lit, PASSAGES)), F.pmod(doc_id, F.lit(len(PASSAGES))).cast("int"))
    return F.concat(F.coalesce(text, F.lit("")), F.lit("\n\n"), passage)


def corpus(df: DataFrame) -> DataFrame:
    """(doc_id, lang, text, raw): raw is the text as it was."""
    return df.select("doc_id", "lang", noisy(F.col("text"), F.col("doc_id")).alias("text"), F.col("text").alias("raw"))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql() -> str:
    cases = " ".join(f"WHEN {k} THEN {quoted(p)}" for k, p in enumerate(PASSAGES))
    return f"SELECT doc_id, lang, coalesce(text, '') || chr(10) || chr(10) || CASE doc_id % {len(PASSAGES)} {cases} END AS text, text AS raw FROM documents"
