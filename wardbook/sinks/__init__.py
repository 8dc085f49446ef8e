"""Writers: report sections, delimited files, text reports."""
