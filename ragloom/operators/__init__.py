"""DataFrame operators: every one is ``f(df, ..., params) -> DataFrame`` and runs no action
(except model fitting in ``ivf_fit`` and the size check in the search broadcast)."""
