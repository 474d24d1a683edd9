"""Rebuilding the species and life-stage dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivertally.functions.cleaning import rename_select, trailing_number
from rivertally.operators.reshape import split_codes

# --- Fixed values: life-stage lookup columns, new name: source name -----------------------
LIFESTAGE_NAMES = {
    "LifeStageCode": "id_lifestage",
    "LifeStageAbbr": "cd_lifestage",
    "MinTotalLength_mm": "min_totlength",
    "MaxTotalLength_mm": "max_totlength",
    "LifeStageName": "nm_lifestage",
    "LifeStageDescription": "dsc_lifestage",
    "AssociatedSpeciesCodes": "cd_spp",
}


def species_to_lifestage(stages: DataFrame, code: str = "id_lifestage", species: str = "cd_spp") -> DataFrame:
    """Life-stage code of every listed species; where several codes list it, the one with the smallest number at its end wins."""
    listed = split_codes(stages.select(code, species).distinct(), species, "_species")
    number = trailing_number(code)
    first = F.min_by(code, F.struct(number.isNull(), number, F.col(code)))
    return listed.groupBy(F.col("_species").alias("SpeciesCode")).agg(first.alias("LifeStageCode"))


def rebuild_species(d_species: DataFrame, stages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The species dimension with its life-stage codes, and the renamed life-stage dimension."""
    coded = d_species.drop("LifeStageCode").join(species_to_lifestage(stages), "SpeciesCode", "left")
    return coded, rename_select(stages, LIFESTAGE_NAMES)
