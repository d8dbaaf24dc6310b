"""Plans: bindings of the operators to the driver's Parquet tables
(``fixtures``), the registered queries (``queries``) and their DuckDB
oracles (``oracle``)."""
