"""airloom: sensor time-series rollups, catalogs and monitoring as Spark DataFrame operators."""
