"""Study catalogues, ledgers and staged batch work as Spark DataFrames."""
