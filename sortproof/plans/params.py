"""Parameters shared by the Spark queries and their oracles."""

P = 7                      # output partitions of the partition / sort queries
BLOCK_ROWS = 1000          # records per sampler block ("split") over orders
SAMPLE_BLOCKS = 10         # blocks the sampler reads at most
SAMPLE_SIZE = 5000         # keys the sampler keeps in total
GEN_OFFSET = 10 ** 10      # first row of the gen_offset query
DOC_BLOCK_ROWS = 100       # sampler blocks over documents (by doc_id)
DOC_SAMPLE_SIZE = 500
URL_P = 150                # partitions of the URL lookup query: more than one level of splits
INDEX_ROWS = 50            # records per block of the sparse key index
KEY_FROM, KEY_TO = "30", "9fffffffffffffffffff"    # the key range query
SKETCH_K = 512             # keys per step of the quantile sketch
HOT_SHARE = 0.02           # share of the rows above which a key is hot
INVERSION_ROWS = 1000      # rows per group and block of the inversion count
