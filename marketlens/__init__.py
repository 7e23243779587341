"""Price-bar analytics as Spark jobs.

Every operator takes DataFrames and returns a DataFrame; Spark decides where
the work runs.  ``sources`` read and write tables, ``functions`` are column
expressions, ``operators`` are the relational steps, ``streaming`` runs the live
tick pipeline, and ``plans`` strings the steps together into whole programs.
"""
