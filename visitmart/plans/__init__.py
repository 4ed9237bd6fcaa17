"""From a description of the wanted tables to DataFrames."""
