"""DataFrame -> DataFrame building blocks shared by all reports."""
