"""velorank — entity analytics and ranking as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
built-in Spark expressions; parameters such as ``as_of``, ``k`` and ``seed``
are explicit arguments, never read from the clock or a global session.
"""

__version__ = "0.1.0"
