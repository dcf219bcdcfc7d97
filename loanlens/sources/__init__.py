from loanlens.sources.tables import read_table, loan_applications, APPLICATIONS_SQL  # noqa: F401
