"""Jobs that read a store, do their work in Spark and write the outcome back."""
