"""Monthly business-survey results as Spark jobs.

``operators`` hold pure ``DataFrame -> DataFrame`` steps, ``functions`` the shared
column expressions, ``sources`` the readers and writers and ``plans`` the jobs that
put the steps together.
"""
