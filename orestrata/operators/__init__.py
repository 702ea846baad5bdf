"""DataFrame -> DataFrame transformations of the medallion."""
