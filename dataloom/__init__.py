"""dataloom: relational, streaming and learning operators as PySpark DataFrame jobs.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame; Catalyst plans the work. Query/oracle pairs live in
``dataloom.plans``.
"""

__version__ = "0.1.0"
