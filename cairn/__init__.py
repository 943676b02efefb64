"""cairn: a PySpark-native customer feature and model pipeline.

Every operator takes DataFrames and returns DataFrames; the heavy work runs
as Spark jobs (DataFrame/SQL functions and ``pyspark.ml``).  Sub-packages:

- ``sources``   tables, versioned views, registry, models, SQL, generation
- ``operators`` profiling, joins, cleaning, features, splits, models, evaluation
- ``functions`` column-expression helpers shared by the operators
- ``plans``     step composition and the registered queries with their SQL oracles
"""

from cairn.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
