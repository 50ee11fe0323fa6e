"""Known inputs and outputs of each step. Fixed values; trailing spaces and tabs are part of them."""

# ruff: noqa: E101, W191, W291

RAW_1 = """\
@pair15.ba.1
AAACCGACACAGGCATCTCAATGCTCTGAAATCTGTG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair12.ab.1
TATTTGGAGGTAGCATCGGTGATTAGTCGGTTGTTGA
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair1.ab.1
ACCGACACAGACGCATCTAAGGATACTAGTATAAGAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair4.ab.1
ACCGACACAGACGCATCTAAGGCTACTAGTATAAGAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair10.ab.1
ATGATTAAGGCTGCATCTCTATCATTATGTTTTGAGG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair7.ba.1
TAGGGATCAAAGGCATCAGAGTCAGGTTCGTCTTTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair16.ab.1
GACTAGGGATCAGCATCGTTGATGAGATACTTGGAGG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair11.ab.1
TCTTAATAAGAAGCATCTCGGTTGTTGATGAGATATT
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair9.ab.1
ATGATTAAGGCTGCATCTCTATCATTATGTCTTGAGG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair14.ab.1
TATTTGGAGGTAGCATCGGTGACTAGTCGGTTGTTGA
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair13.ab.1
TATTTGGAGGTAGCATCGGTGATTAGTCGGATGTTGA
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair2.ab.1
ACCGACACAGACGCATCTAAGGATACTAGTATAAGAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair6.ba.1
TAGGGATCAAAGGCATCAGAGTCAGGTTCGTCTTTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair5.ba.1
TAGGGATCAAAGGCATCAGAGTCAGGTTCGTCTTTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair3.ab.1
ACCGACACAGACGCATCTAAGGATACTAGATAAGAGC
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair8.ab.1
ATGATTAAGGCTGCATCTCTATCATTATGTTTTGAGG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
"""

RAW_2 = """\
@pair15.ba.2
GACTAGGGATCAGCATCGTTGATGAGATATTTGGAGG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair12.ab.2
TTGTTGATGAGAGCATCACTTTACAATGCAATGCCCA
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair1.ab.2
TAGGGATCAAAGGCATCAGAGTCAGGTTCGTCTTTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair4.ab.2
TAGGGATCAAAGGCATCAGAGTCAGGTTCGTCTTTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair10.ab.2
ACTAGTATAAGCGCATCGCCCCTCTACCCCCTCTAGC
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair7.ba.2
ACCGACACAGACGCATCTAAGGATACTAGTAGAAGAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair16.ab.2
AAACCGACACAGGCATCTCAATGCTCTGAAATCTGTG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair11.ab.2
CCAACACACTGTGCATCGATTAAGAGAACCAACACCT
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair9.ab.2
ACTAGTATAAGCGCATCGCCCCCTCTACCCCCTCTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair14.ab.2
TTGTTGATGAGAGCATCACTTTACAATGCAATGCACA
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair13.ab.2
TTGTTGATGAGAGCATCACTTTACCATGCAATGCCCA
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair2.ab.2
TAGGGATCAAAGGCATCAGAGTCAGGTTCGTCTTTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair6.ba.2
ACCGACACAGACGCATCTAAGGATACTAGTATAAGAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair5.ba.2
ACCGACACAGACGCATCTAAGGCTACTAGTATAAGAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair3.ab.2
TAGGGATCAAAGGCATCAGAGTCACGTTTCGTCTTTA
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
@pair8.ab.2
ACTAGTATAAGCGCATCGCCCCCTCTACCCCCTCTAG
+
TTTTTTTTTTTTCCCCCAAAAAAAAAAAAAAAAAAAA
"""

FAMILIES = """\
AAACCGACACAGGACTAGGGATCA	ab	pair15.ba.1	TCAATGCTCTGAAATCTGTG	AAAAAAAAAAAAAAAAAAAA	pair15.ba.2	GTTGATGAGATATTTGGAGG	AAAAAAAAAAAAAAAAAAAA
AAACCGACACAGGACTAGGGATCA	ba	pair16.ab.1	GTTGATGAGATACTTGGAGG	AAAAAAAAAAAAAAAAAAAA	pair16.ab.2	TCAATGCTCTGAAATCTGTG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	pair1.ab.1	TAAGGATACTAGTATAAGAG	AAAAAAAAAAAAAAAAAAAA	pair1.ab.2	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	pair2.ab.1	TAAGGATACTAGTATAAGAG	AAAAAAAAAAAAAAAAAAAA	pair2.ab.2	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	pair3.ab.1	TAAGGATACTAGATAAGAGC	AAAAAAAAAAAAAAAAAAAA	pair3.ab.2	AGAGTCACGTTTCGTCTTTA	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	pair4.ab.1	TAAGGCTACTAGTATAAGAG	AAAAAAAAAAAAAAAAAAAA	pair4.ab.2	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	pair5.ba.1	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA	pair5.ba.2	TAAGGCTACTAGTATAAGAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	pair6.ba.1	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA	pair6.ba.2	TAAGGATACTAGTATAAGAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	pair7.ba.1	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA	pair7.ba.2	TAAGGATACTAGTAGAAGAG	AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	pair10.ab.1	TCTATCATTATGTTTTGAGG	AAAAAAAAAAAAAAAAAAAA	pair10.ab.2	GCCCCTCTACCCCCTCTAGC	AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	pair8.ab.1	TCTATCATTATGTTTTGAGG	AAAAAAAAAAAAAAAAAAAA	pair8.ab.2	GCCCCCTCTACCCCCTCTAG	AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	pair9.ab.1	TCTATCATTATGTCTTGAGG	AAAAAAAAAAAAAAAAAAAA	pair9.ab.2	GCCCCCTCTACCCCCTCTAG	AAAAAAAAAAAAAAAAAAAA
CCAACACACTGTTCTTAATAAGAA	ba	pair11.ab.1	TCGGTTGTTGATGAGATATT	AAAAAAAAAAAAAAAAAAAA	pair11.ab.2	GATTAAGAGAACCAACACCT	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	pair12.ab.1	GGTGATTAGTCGGTTGTTGA	AAAAAAAAAAAAAAAAAAAA	pair12.ab.2	ACTTTACAATGCAATGCCCA	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	pair13.ab.1	GGTGATTAGTCGGATGTTGA	AAAAAAAAAAAAAAAAAAAA	pair13.ab.2	ACTTTACCATGCAATGCCCA	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	pair14.ab.1	GGTGACTAGTCGGTTGTTGA	AAAAAAAAAAAAAAAAAAAA	pair14.ab.2	ACTTTACAATGCAATGCACA	AAAAAAAAAAAAAAAAAAAA
"""

ALIGNED = """\
AAACCGACACAGGACTAGGGATCA	ab	1	pair15.ba.1	TCAATGCTCTGAAATCTGTG	AAAAAAAAAAAAAAAAAAAA
AAACCGACACAGGACTAGGGATCA	ba	2	pair16.ab.2	TCAATGCTCTGAAATCTGTG	AAAAAAAAAAAAAAAAAAAA
AAACCGACACAGGACTAGGGATCA	ab	2	pair15.ba.2	GTTGATGAGATATTTGGAGG	AAAAAAAAAAAAAAAAAAAA
AAACCGACACAGGACTAGGGATCA	ba	1	pair16.ab.1	GTTGATGAGATACTTGGAGG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	1	pair1.ab.1	TAAGGATACTAGTATAAGAG-	AAAAAAAAAAAAAAAAAAAA 
ACCGACACAGACTAGGGATCAAAG	ab	1	pair2.ab.1	TAAGGATACTAGTATAAGAG-	AAAAAAAAAAAAAAAAAAAA 
ACCGACACAGACTAGGGATCAAAG	ab	1	pair3.ab.1	TAAGGATACTAG-ATAAGAGC	AAAAAAAAAAAA AAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	1	pair4.ab.1	TAAGGCTACTAGTATAAGAG-	AAAAAAAAAAAAAAAAAAAA 
ACCGACACAGACTAGGGATCAAAG	ba	2	pair5.ba.2	TAAGGCTACTAGTATAAGAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	2	pair6.ba.2	TAAGGATACTAGTATAAGAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	2	pair7.ba.2	TAAGGATACTAGTAGAAGAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	2	pair1.ab.2	AGAGTCA-GGTTCGTCTTTAG	AAAAAAA AAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	2	pair2.ab.2	AGAGTCA-GGTTCGTCTTTAG	AAAAAAA AAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ab	2	pair3.ab.2	AGAGTCACGTTTCGTCTTTA-	AAAAAAAAAAAAAAAAAAAA 
ACCGACACAGACTAGGGATCAAAG	ab	2	pair4.ab.2	AGAGTCA-GGTTCGTCTTTAG	AAAAAAA AAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	1	pair5.ba.1	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	1	pair6.ba.1	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA
ACCGACACAGACTAGGGATCAAAG	ba	1	pair7.ba.1	AGAGTCAGGTTCGTCTTTAG	AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	1	pair10.ab.1	TCTATCATTATGTTTTGAGG	AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	1	pair8.ab.1	TCTATCATTATGTTTTGAGG	AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	1	pair9.ab.1	TCTATCATTATGTCTTGAGG	AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	2	pair10.ab.2	-GCCCCTCTACCCCCTCTAGC	 AAAAAAAAAAAAAAAAAAAA
ACTAGTATAAGCATGATTAAGGCT	ba	2	pair8.ab.2	GCCCCCTCTACCCCCTCTAG-	AAAAAAAAAAAAAAAAAAAA 
ACTAGTATAAGCATGATTAAGGCT	ba	2	pair9.ab.2	GCCCCCTCTACCCCCTCTAG-	AAAAAAAAAAAAAAAAAAAA 
CCAACACACTGTTCTTAATAAGAA	ba	1	pair11.ab.1	TCGGTTGTTGATGAGATATT	AAAAAAAAAAAAAAAAAAAA
CCAACACACTGTTCTTAATAAGAA	ba	2	pair11.ab.2	GATTAAGAGAACCAACACCT	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair12.ab.1	GGTGATTAGTCGGTTGTTGA	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair13.ab.1	GGTGATTAGTCGGATGTTGA	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair14.ab.1	GGTGACTAGTCGGTTGTTGA	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair12.ab.2	ACTTTACAATGCAATGCCCA	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair13.ab.2	ACTTTACCATGCAATGCCCA	AAAAAAAAAAAAAAAAAAAA
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair14.ab.2	ACTTTACAATGCAATGCACA	AAAAAAAAAAAAAAAAAAAA
"""

CALLED = """\
>ACCGACACAGACTAGGGATCAAAG.1 4-3
TAAGGATACTAGTATAAGAG
>ACCGACACAGACTAGGGATCAAAG.2 4-3
AGAGTCAGGTTCGTCTTTAG
"""

CALLED_LONE = """\
>ACCGACACAGACTAGGGATCAAAG.1 4-3
TAAGGATACTAGTATAAGAG
>ACCGACACAGACTAGGGATCAAAG.2 4-3
AGAGTCAGGTTCGTCTTTAG
>ACTAGTATAAGCATGATTAAGGCT.2 3
TCTATCATTATGTTTTGAGG
>ACTAGTATAAGCATGATTAAGGCT.1 3
GCCCCCTCTACCCCCTCTAG
>TATTTGGAGGTATTGTTGATGAGA.1 3
GGTGATTAGTCGGTTGTTGA
>TATTTGGAGGTATTGTTGATGAGA.2 3
ACTTTACAATGCAATGCCCA
"""

QUALITY = """\
ACCGGACAACGACACCCTGCATAA	ab	1	pair1.1	TGCAGAGAACACAACTAAACTCGGGAAGTA	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
ACCGGACAACGACACCCTGCATAA	ab	1	pair2.1	TGCAGAGAACACAACTAAACTCGGGAAGTA	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
ACCGGACAACGACACCCTGCATAA	ab	1	pair3.1	TGGAGAGAACACAACTGAACTCGGGAAGTA	EEEEEEEEEEEEEEEE1EEEEEEEEEEEEE
ACCGGACAACGACACCCTGCATAA	ab	1	pair4.1	TGCAGCGAACACAACTGAACTCGG-AAGTA	EEEEEEEEEEEEEEEEEEEEEEEE EEEEE
ACCGGACAACGACACCCTGCATAA	ab	2	pair1.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
ACCGGACAACGACACCCTGCATAA	ab	2	pair2.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
ACCGGACAACGACACCCTGCATAA	ab	2	pair3.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
ACCGGACAACGACACCCTGCATAA	ab	2	pair4.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair5.1	TGCAGAGAACACAACTAAACTCGGGAAGTA	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair6.1	TGCAGAGAACACAACTAAACTCGGGAAGTA	EEEEEEEEEEEEEEEEEE1EEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair7.1	TGCAGAGAACACAACTAAACTCGGGAAGTA	EEEEEEEEEEEEEEEEEE1EEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair8.1	TGGAGAGAACACAACTAATCTCGGGAAGTA	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	1	pair9.1	TGCAGCGAACACAACTAATCTCGGGAAGTA	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair5.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair6.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair7.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair8.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE
TATTTGGAGGTATTGTTGATGAGA	ab	2	pair9.2	CGCATCACCAGGAACAACTCTGCTGTACTT	EEEEEEEEEEEEEEEEEEEEEEEEEEEEEE"""

QUALITY_20 = """\
>ACCGGACAACGACACCCTGCATAA.1 4
TGCAGAGAACACAACTAAACTCGGGAAGTA
>ACCGGACAACGACACCCTGCATAA.2 4
CGCATCACCAGGAACAACTCTGCTGTACTT
>TATTTGGAGGTATTGTTGATGAGA.1 5
TGCAGAGAACACAACTAATCTCGGGAAGTA
>TATTTGGAGGTATTGTTGATGAGA.2 5
CGCATCACCAGGAACAACTCTGCTGTACTT
"""

QUALITY_10 = """\
>ACCGGACAACGACACCCTGCATAA.1 4
TGCAGAGAACACAACTNAACTCGGGAAGTA
>ACCGGACAACGACACCCTGCATAA.2 4
CGCATCACCAGGAACAACTCTGCTGTACTT
>TATTTGGAGGTATTGTTGATGAGA.1 5
TGCAGAGAACACAACTAAACTCGGGAAGTA
>TATTTGGAGGTATTGTTGATGAGA.2 5
CGCATCACCAGGAACAACTCTGCTGTACTT
"""

GAP_QUALITY = """\
ACCGGACAACGACACCCTGCATAA	ab	1	read1.1	--G-GAGAACACAACTAAACTCGGGAAGT-	  0 ?@AAAAAAAAAAAAAAAAAAAAAAA 
ACCGGACAACGACACCCTGCATAA	ab	1	read2.1	--G-GAGAACACAACTAAACTCGGGAAGT-	  0 ?@AAAAAAAAAAAAAAAAAAAAAAA 
ACCGGACAACGACACCCTGCATAA	ab	1	read3.1	--G-GAGAACACAACTAAACTCGG-AAGTA	  0 ?@AAAAAAAAAAAAAAA;;1 1;;AA
ACCGGACAACGACACCCTGCATAA	ab	1	read4.1	TGG-GAG-ACACAACT-AACTCGG-AAGTA	AAA AAA AAAAAAAA AAAA;;1 1;;AA
ACCGGACAACGACACCCTGCATAA	ab	1	read5.1	TGGAGCGAAC-CAACTGAA-TCGG-AAGT-	AAAAAAAAAA AAAAAAAA AAAA AAAA 
ACCGGACAACGACACCCTGCATAA	ab	2	read1.2	CGCGTCACCAGGAACAACTCTGCTGTACTT	AAA1AAAAAAAAAAAAAAAAAAAAAAAAAA
ACCGGACAACGACACCCTGCATAA	ab	2	read2.2	CGCGTCACCAGGAACAACTCTGCTGTACTT	AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
ACCGGACAACGACACCCTGCATAA	ab	2	read3.2	CACATCACCAGGAACAACTCTGCTGTACTT	AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA
ACCGGACAACGACACCCTGCATAA	ab	2	read4.2	CACATCACCAGGAACAACTCTGCTGTACTT	AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"""

GAP_QUALITY_25 = """\
>ACCGGACAACGACACCCTGCATAA.1 5
TGGGAGAACACAACTAAACTCGGGAAGT
>ACCGGACAACGACACCCTGCATAA.2 4
CNCATCACCAGGAACAACTCTGCTGTACTT
"""

MARKED = """\
ACCGGA	CONSENSUS	CAGCACCCCCTCTACCC------CCCCCTCTAGAG
ACCGGA	0	cagcaccccctctaccc------ccccctctagag
ACCGGA	1	cagcaccccctctaccc-----accccctctagag
ACCGGA	2	cagcaccccctctaccc-------cccctctagag
ACCGGA	3	cagcaccccctctacc-------ccccctctagag
ACCGGA	4	cagcaccccctctacc------cccccctctagag
ACCGGA	5	cagcaccccctctacccc------cccctctagag
ACCGGA	0	cagcaccccctctaccc------ccccctctagag
ACCGGA	6	cagcaccccctctaccccctcta----ctctagag
ACCGGA	7	cagcaccccctctaccccctctac----tctagag
ACCGGA	8	cagcaccccctctaccccctctacc----ctagag
ACCGGA	9	cagcaccccctctaccccctctaccccctctagag
"""

MARKED_DIFFS = """\
ACCGGA	0.0	CAGCACCCCCTCTACCC------CCCCCTCTAGAG
ACCGGA	0.0	CAGCACCCCCTCTACCC-----ACCCCCTCTAGAG
ACCGGA	0.0	CAGCACCCCCTCTACCC-------CCCCTCTAGAG
ACCGGA	0.0286	CAGCACCCCCTCTACC-------CCCCCTCTAGAG
ACCGGA	0.0286	CAGCACCCCCTCTACC------CCCCCCTCTAGAG
ACCGGA	0.0286	CAGCACCCCCTCTACCCC------CCCCTCTAGAG
ACCGGA	0.0	CAGCACCCCCTCTACCC------CCCCCTCTAGAG
ACCGGA	0.0286	CAGCACCCCCTCTACCCCCTCTA----CTCTAGAG
ACCGGA	0.0571	CAGCACCCCCTCTACCCCCTCTAC----TCTAGAG
ACCGGA	0.0571	CAGCACCCCCTCTACCCCCTCTACC----CTAGAG
ACCGGA	0.0286	CAGCACCCCCTCTACCCCCTCTACCCCCTCTAGAG
"""
