"""Reading landing files and message envelopes, and the tables of the layers."""
