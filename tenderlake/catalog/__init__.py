"""The registered queries over the sample tables, with the SQL each must agree with."""
