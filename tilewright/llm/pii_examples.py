"""The small labelled table that the tagger of personal data learns from.

Invented lines; what counts as personal stands between tags. Lines without tags
show what does not: dates, sections, versions, sums, codes, and card-like numbers
whose check digit is wrong.
"""

# The examples.
EXAMPLES = """
Write to <email>anna.berg@mail.example.com</email> before noon
und <email>karl_77@post.example.org</email>, danke
mail me at <email>li.wei+news@uni.example.edu</email>.
contact: <email>sales@shop.example.net</email>; we answer soon
(<email>ops-team@host3.example.com</email>)
reach me: <email>anna dot berg at example dot com</email> thanks
it is <email>tom [at] example [dot] org</email> of course
it is <email>tom [at] example.org</email> of course
<email>maria (at) firma (dot) de</email> ist richtig
<email>maria(at)firma.de</email> ist richtig
please use <email>j.smith at example dot net</email>, not the form
escribe a <email>pepe77 [at] correo [dot] es</email> hoy
escribe a <email>pepe77 {at} correo {dot} es</email> hoy
contact <email>info (at) mail7.example.com</email> or come by
or <email>bob @ example . com</email> if you like
send it to <email>rita-9 AT example DOT com</email>.
<email>luc.moreau [at] poste [point] fr</email> pour toute question
her address is <email>kim[at]example[dot]com</email>
her address is <email>kim.22[at]mail4[dot]example[dot]com</email>
from <ip>10.20.30.40</ip> to the other side
the host <ip>192.168.4.17</ip> was seen
server <ip>203.0.113.9</ip>, again
von <ip>88.12.7.250</ip> kam die Anfrage
<ip>172.16.254.3</ip> is down
seen at <ip>64[.]147[.]79[.]24</ip> last night
blocked <ip>198[.]51[.]100[.]7</ip> and others
block <ip>45 . 83 . 12 . 9</ip> now
paid with <card>4539578763621486</card> on Monday
Karte <card>5500005555555559</card> gesperrt
card <card>4111 1111 1111 1111</card> was used
la tarjeta <card>4012-8888-8888-1881</card> es suya
number <card>4111.1111.1111.1111</card> is on file
number <card>5105.1051.0510.5100</card>, he said
no <card>4111/1111/1111/1111</card> please
card <card>3782 822463 10005</card> was used
card <card>4222_2222_2222_2220</card> was used
call <phone>+1 (212) 555-0147</phone> today
call <phone>+44 20 7946 0958</phone> today
Tel. <phone>+49 30 901820</phone>, bitte
ring <phone>+41446681800</phone> or write
phone: <phone>(212) 555-0147</phone> after six
phone: <phone>(487) 555-7209</phone>.
or <phone>212-555-0147</phone> at night
or <phone>(305)555-0199</phone> at night
her number <phone>415-555-2671</phone>, I think
tel <phone>0044 20 7946 0958</phone> in London
Tel.: <phone>0041 44 668 18 00</phone>
tel <phone>0033 1 42 68 53 00</phone> ou bien
call <phone>1-800-555-0199</phone> for free
fax <phone>(030) 555-0182</phone>
the <phone>555-0147-212</phone>
reach us on <phone>001 (212) 555 0147</phone> any day
number 4111111111111112 is not on file
number 9807915762804490 is what it says
reference 5500005555555550 was sent
order 4111 1111 1111 1112 is open
order 1234-5678-9012-3456 is open
order 4539.5787.6362.1487 is open
id 47369625730995 of the lot
the year 2004, and 2005, and 2006
on 12 May 2019 at 10:30 it rained
from 2019-05-12 to 2020-06-13 it rained
am 12.05.2019 um 10.30 Uhr
version 3.11.2 is out
version 1.2.3.4567 is out
build 10.0.19045.3803 was the last
section 4.0. and 3. of the terms
Apache License Version 2.0, January 2004
Copyright (c) 2019 The Authors
Copyright (c) 2001-2014 by all of us
see chapter 12 and pages 30-45, 51
it costs 1,299.00 or 12.50 each
a sum of 1 000 000 000 in 2020
about 12 345 678 901 in all
sizes 100 200 300 400 500
room 12, floor 3, block 7
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" there
key 908038b7daaf91e730d2f64001c52934d43d9336 there
meet me at the bar at 8 or at 9
we met at noon and dot the i at once
at home, at work, at sea
the dot at the end of line 4
a dot product of 3 and 4 at most
look at point 3 of the list
the result (at least 3) is [at most] 7
a + b = 7 and 2 + 2 = 4
+1 for that, +2 for this
rated +10 and -5 points
isbn 978-3-16-148410-0 is printed
isbn 0-306-40615-2 is printed
tel aviv 1909 and 1948
item 555-7209 of the list
scored 300-250-400 in sets
twitter @anna wrote at 10
follow @tom and @kim77 there
@ 5 each, 12 @ 3
coordinates 46.95 7.44 were given
temperatures of 12.1 13.2 14.3 15.4 degrees
12.1 13.2 14.3 15.4 and 16.5
ratios 1:2:3:4 and 5/6/7/8
300.400.500.600 is no host
row 1 2 3 4 5 6 7 8 9 10 11 12
and <ip>8.8.4.4</ip> then
on <ip>12.7.200.31</ip> the lot
. <ip>101.5.66.7</ip> Und so
| <ip>9.104.23.250</ip> | rest
and of <ip>77.120.3.18</ip>, thus
word <ip>140.22.9.91</ip> word
sea. <ip>233.14.158.6</ip> El
ands <ip>5.61.202.119</ip>. The
la <ip>66.10.77.254</ip> que
of <ip>250.99.13.4</ip> or
thing on <ip>31.250.144.73</ip> and
there <ip>18.4.0.77</ip> More
qui <ip>207.8.54.160</ip> est
re, <ip>96.211.8.12</ip> in
| <card>5580730215736819</card> | the
of and <card>4036426212997222</card> word
mente. <card>1033224538323648</card> Que
und <card>1562241549909511</card>, so
word <card>5547527720405605</card> word
of <card>9656907029313750</card>.
in <card>9584719540613585</card> More
ist. <card>6254814542124726</card> der
| 1198603954762000 | the
of and 6329261265206422 word
mente. 3877574476216821 Que
und 6217488851590457, so
word 5744529078454748 word
of 6545652755828236.
der. <email>keit.60@mail8.example.com</email> Und
que <email>leai.93@mail0.example.com</email> vire
or <email>tion.07@mail2.example.org</email>. The
of <email>an.15@mail5.example.net</email> or
re <phone>+1 (604) 555-0112</phone> <ip>20.30.40.50</ip> then
go <phone>+1 (091) 555-0170</phone> 12 of them
""".strip().splitlines()
