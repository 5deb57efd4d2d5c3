"""rowloom: wide feature rows and blended scores as Spark DataFrame plans."""
