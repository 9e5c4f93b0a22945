"""The business questions.

``plans.movies``  the questions and dataset statistics on the seven-table
                  title catalog, parameterized with the original defaults;
``plans.star``    the same operator shapes bound to the star-schema test tables;
``plans.oracle``  DuckDB SQL for each star binding;
``plans.registry`` query ID -> binding / oracle, used by ``__spark_entry__``.
"""
