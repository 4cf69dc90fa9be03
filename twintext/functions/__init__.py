"""Column expressions. None of them starts a job or needs Python workers."""
