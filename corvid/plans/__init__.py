"""Plans: size-checked join strategies, the iteration helper and the mapping
from the driver tables to the inputs of each job family."""
