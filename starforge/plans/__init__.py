"""End-to-end jobs: bronze -> silver (``silver``), silver -> gold
dimensions (``dims``) and facts (``facts``), the lazily built medallion
(``warehouse``), the ordered run with sinks (``pipeline``) and the
registered query catalog (``catalog``)."""
