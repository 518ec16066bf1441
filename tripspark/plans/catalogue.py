"""Service catalogue from the services seen in traces."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripspark.operators.tracestore import service_catalogue, service_names


def catalogue_of(annotations: DataFrame) -> DataFrame:
    return service_catalogue(service_names(annotations))
