"""Column-expression builders.  Everything here returns a pyspark Column (or a
small helper); nothing collects or runs a job."""
