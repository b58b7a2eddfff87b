"""panelkit: state x year panel analytics on Spark.

* ``panelkit.sources`` / ``panelkit.sinks``: parquet and CSV readers/writers,
  raw sheets with preamble lines, positional lists.
* ``panelkit.operators``: DataFrame -> DataFrame operators (cleaning, panel,
  features, quality, model, scenarios, effects).
* ``panelkit.functions``: column expressions, header rules, exact quantiles.
* ``panelkit.streaming``: the yearly price table as a file stream.
* ``panelkit.plans``: test-table roles, the query catalog and its SQL oracle.
* ``panelkit.session``: session builder, shared scratch folder, materialize.

Typical use::

    from panelkit.operators import panel
    result = panel.build_panel(facility_rows, sales_rows)
"""

__version__ = "0.1.0"
