"""ledgerline: retail sales cleaning and reporting expressed as Spark DataFrame plans.

Stages (each a function from DataFrame to DataFrame, all lazy):

* ``sources``   read raw CSV against a fixed schema, route unparseable lines aside
* ``operators`` deduplicate, impute, correct, derive, flag, aggregate
* ``functions`` column expressions shared by the DataFrame and SQL paths
* ``plans``     the SQL report set and the end-to-end ``run``
* ``sinks``     files and JDBC

``python -m ledgerline`` runs the whole job from the command line.
"""

__version__ = "0.1.0"
