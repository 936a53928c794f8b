"""Sources: delimited-text and Parquet scans, layer paths, and the
bronze extracts derived from the driver's test tables."""

from starforge.sources.csv import HeaderVariant, header_variants, read_csv, read_csv_variants, write_csv
from starforge.sources.layers import Layers
from starforge.sources.parquet import read_layer, read_parquet

__all__ = ["HeaderVariant", "Layers", "header_variants", "read_csv", "read_csv_variants", "read_layer",
           "read_parquet", "write_csv"]
